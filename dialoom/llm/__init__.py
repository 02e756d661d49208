"""Training-data operators: sanitising, packing, deduplication, scoring, sharding and token files."""
