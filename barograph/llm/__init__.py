"""Training-data operators: tokenising, sharding, scoring, filtering, deduplication, scanning."""
