"""Table declarations, Parquet reading and writing."""
