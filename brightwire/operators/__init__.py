"""Transforms: DataFrame -> DataFrame, lazy, with an explicit ``as_of``."""
