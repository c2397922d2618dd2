"""The corpus pipeline: toxicity, exact dedup, near dedup, packing. Each stage is written as Parquet and reread.

Defined results: null and empty texts are equal and stay once, by the row with the largest doc_id; a row with a null doc_id
is judged by its text like others, sorts below every other doc_id in exact dedup, and is a near copy of nothing; rows
repeated outright become one; other columns, whatever their names, are kept as they are by all stages but the last; where
the labels know one class only, no document is toxic; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brightwire.llm import exact_dedup, near_dup, toxicity
from brightwire.llm.common import cut, read_table
from brightwire.llm.queries import packed, toxicity_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine takes for toxic go; it is fitted to labelled rows of ``docs``."""
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id stays."""
    return exact_dedup.keep_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dup.keep_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, with their sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("packing", packing_stage)]

#: The classifier, the tokenizer and the genetic search have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
