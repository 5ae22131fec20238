"""Trip analytics on Spark: CSV to a growing date-partitioned table, and on to per-day documents."""
