"""Parquet, object and sheet sinks."""
