"""Batch windows, archive files, extraction, Parquet tables."""
