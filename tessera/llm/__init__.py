"""Training-data operators: secret scans, quality, URL filters, dedup, sharding, mixing, packing."""
