"""Stage graphs and the catalogue of queries."""
