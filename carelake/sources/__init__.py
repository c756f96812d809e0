"""Readers and writers: delimited text, the Parquet core store, the driver's tables."""
