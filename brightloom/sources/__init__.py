"""Readers and writers for text, CSV and Parquet."""
