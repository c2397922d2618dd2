"""Explicit times. ``as_of`` is a naive UTC datetime; no transform asks the clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(as_of: datetime, df: DataFrame, like: str) -> Column:
    """``as_of`` as a literal of the type of the column ``like``."""
    return F.lit(as_of.isoformat(sep=" ")).cast(df.schema[like].dataType)


def day(as_of: datetime, back: int = 0) -> Column:
    return F.lit(day_of(as_of, back))


def day_of(as_of: datetime, back: int = 0) -> date:
    return (as_of - timedelta(days=back)).date()


def seen_at() -> Column:
    """When an article counts as published."""
    return F.coalesce("published_at", "ingested_at")
