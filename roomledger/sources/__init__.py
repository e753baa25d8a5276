"""Stored pages, line files, CSV and layered Parquet tables."""
