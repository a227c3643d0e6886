"""Event-archive analytics on Spark: ordering, state rebuilding, as-of grids, classification, publication."""
