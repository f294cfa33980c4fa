"""Training-data operators: mixing, filtering, deduplication, formatting and counting of text corpora."""
