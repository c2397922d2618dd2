"""Rows beside what their group has in common, without a window: no group is gathered in one task.

Groups are aggregated with map-side combine, and only groups of at least ``least`` rows go on; their results go back by two
joins. Those of groups with more than ``LARGE`` rows, of which there can be no more than the rows divided by that, are
broadcast, so the rows of a large group stay where they are. The rest is an equi-join; rows that need none of it (settled
by the first join, or without a key) are dealt by a value of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups with more rows than this are broadcast.
LARGE = 100_000


def beside(rows: DataFrame, key: Column, deal: str, least: int = 2, large: int | None = None, **aggregates: Column) -> DataFrame:
    """``rows`` with ``aggregates`` of the rows with the same ``key``, null where it is null or has fewer than ``least`` rows. ``deal``: a column whose values differ."""
    large = LARGE if large is None else large
    names = list(aggregates)
    found = rows.groupBy(key.alias("_key")).agg(F.count("*").alias("_rows"), *(a.alias(n) for n, a in aggregates.items()))
    found = found.filter(F.col("_key").isNotNull() & (F.col("_rows") >= least))
    of = lambda kind, groups: groups.select(F.col("_key").alias(f"_{kind}_key"), F.struct(*names).alias(f"_{kind}"))
    many, few = of("many", found.filter(F.col("_rows") > large)), of("few", found.filter(F.col("_rows") <= large))
    out = rows.withColumn("_own", key).join(F.broadcast(many), F.col("_own") == F.col("_many_key"), "left")
    dealt = F.when(F.col("_own").isNull() | F.col("_many").isNotNull(), F.concat(F.lit("\0"), F.col(deal))).otherwise(F.col("_own"))
    out = out.withColumn("_own", dealt).join(few, F.col("_own") == F.col("_few_key"), "left")
    got = F.coalesce("_many", "_few")
    return out.withColumns({n: got[n] for n in names}).drop("_own", "_many_key", "_many", "_few_key", "_few")


def with_found(rows: DataFrame, found: DataFrame, *key: str) -> DataFrame:
    """``rows`` with the columns of ``found``, which has a key once, or nulls: a left join that is sorted by a hash of the key before the key itself, as texts that begin alike (hosts) are slow to compare."""
    found = found.select(F.xxhash64(*key).alias("_hash"), *(F.col(k).alias(f"_found_{k}") for k in key), *(c for c in found.columns if c not in key))
    rows = rows.withColumn("_own_hash", F.xxhash64(*key))
    same = [F.col("_own_hash") == F.col("_hash"), *(F.col(k) == F.col(f"_found_{k}") for k in key)]
    return rows.join(found, same, "left").drop("_own_hash", "_hash", *(f"_found_{k}" for k in key))
