"""Curatrix: curation of document collections as PySpark DataFrame transformations."""
