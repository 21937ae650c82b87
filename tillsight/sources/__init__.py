"""Readers and loaders: Parquet tables, CSV validation, inference, raw load."""
