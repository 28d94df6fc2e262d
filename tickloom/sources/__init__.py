"""Feed readers and date-partitioned tables."""
