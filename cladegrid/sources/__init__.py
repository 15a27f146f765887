"""Readers and writers for text formats used at the edges; Parquet is used between stages."""
