"""Continuous ingest of batch files."""
