"""The same curation steps over arriving batches."""
