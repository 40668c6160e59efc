"""Readers and writers: parquet tables, response logs, landed responses."""
