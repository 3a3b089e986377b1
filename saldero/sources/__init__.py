"""Sales sources and the partitioned Parquet lake."""
