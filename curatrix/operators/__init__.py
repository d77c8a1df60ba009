"""Curation operators: joins, representatives, review rules, labels, classifiers."""
