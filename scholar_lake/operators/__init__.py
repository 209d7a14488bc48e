"""DataFrame operators: flattening, deduplication, keyed delete and replace, search, lookups, metrics."""
