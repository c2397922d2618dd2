"""Exact dedup by progressive refinement: byte length, then a prefix hash, then a full hash. DataFrame functions only.

1. One narrow scan gives each row its byte length and the hash of its first ``PREFIX`` characters. Lengths that occur
   once are settled; of the rest, (length, prefix hash) pairs that occur once are settled.
2. Only rows of surviving groups have their whole content hashed (SHA-256); equal hashes are equal texts.

Grouping is by aggregates with map-side combine, so a group of copies that holds a third of all rows reaches its reducer
as one row per map task. Verdicts go back by equi-joins with written tables: up to ``BROADCAST_GROUPS`` rows are broadcast;
more are joined by a shuffle of two plain tables, whose hot partitions adaptive execution can split.

Defined results: a null text equals an empty text; null doc_ids sort below all others; rows repeated with the same doc_id
and text are all marked kept where that doc_id stays (``keep_rows`` returns one of them); an empty table gives no rows;
other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwire.llm.common import cut, id_text

#: Characters of a text that the second refinement hashes.
PREFIX = 256
#: Tables of groups or rows to drop up to this number (128 bytes each at most) are broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 250_000


def narrow(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_bytes", F.octet_length("text")).withColumn("prefix_hash", F.xxhash64(F.substring("text", 1, PREFIX)))


def _small(rows: DataFrame) -> DataFrame:
    """``rows`` of a written table, marked for a broadcast where its checked size allows it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_GROUPS else rows


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, prefix_hash, full_hash (null where not needed), keep_id, group_size, kept."""
    docs = id_text(docs, id_col, text_col)
    rows = cut(narrow(docs).drop("text"), "exact-narrow")
    sizes = rows.groupBy("n_bytes", "prefix_hash").agg(F.count("*").alias("n"))
    lengths = sizes.groupBy("n_bytes").agg(F.sum("n").alias("n")).filter("n > 1").select("n_bytes")
    groups = _small(cut(sizes.filter("n > 1").join(lengths, "n_bytes", "left_semi").drop("n"), "exact-groups"))
    same = ["n_bytes", "prefix_hash"]
    hashed = cut(narrow(docs).join(groups, same, "left_semi").withColumn("full_hash", F.sha2("text", 256)).drop("text"), "exact-hashed")
    sets = hashed.groupBy(*same, "full_hash").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    copies = hashed.join(_small(cut(sets, "exact-sets")), [*same, "full_hash"])
    alone = rows.join(groups, same, "left_anti").select(
        "doc_id", *same, F.lit(None).cast("string").alias("full_hash"), F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    return alone.unionByName(copies).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows repeated outright, one."""
    found = exact_dedup(docs, id_col, text_col)
    key = ["doc_id", "n_bytes", "prefix_hash", "full_hash"]
    repeated = cut(found.filter("kept").groupBy(*key).count().filter("count > 1").drop("count"), "exact-repeated")
    leave = cut(found.filter("not kept").select(*key).distinct().unionByName(repeated), "exact-leave")
    leave = _small(leave)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("k_id"), F.coalesce(F.col(text_col), F.lit("")).alias("k_text"))
    own = own.withColumn("k_bytes", F.octet_length("k_text")).withColumn("k_prefix", F.xxhash64(F.substring("k_text", 1, PREFIX)))
    match = (
        F.col("k_id").eqNullSafe(F.col("doc_id")) & (F.col("k_bytes") == F.col("n_bytes")) & (F.col("k_prefix") == F.col("prefix_hash"))
        & (F.col("full_hash").isNull() | (F.sha2("k_text", 256) == F.col("full_hash")))
    )
    kept = own.join(leave, match, "left_anti").select("row")
    if repeated.isEmpty():
        return kept.select("row.*")
    return kept.unionByName(own.join(repeated, match).groupBy(*key).agg(F.first("row").alias("row")).select("row")).select("row.*")
