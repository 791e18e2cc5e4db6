"""Training-data operators: packing, search, fingerprints, mixing, deduplication, sharding, classifiers, encoding."""
