"""Training-data operators: mixing, deduplication, scoring, filtering, packing, sharding and search of documents."""
