"""Training-data operators: mixing, deduplication, search, scoring, classifiers and sharding of text tables."""
