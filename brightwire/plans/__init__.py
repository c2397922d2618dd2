"""Composed queries: serving, operations, checks, the registered queries and their SQL."""
