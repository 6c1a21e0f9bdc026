"""Readers, writers, publishing and table maintenance over Parquet directories."""
