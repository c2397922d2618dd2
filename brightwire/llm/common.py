"""What the operators of this subpackage share: input normalisation, scratch tables, word hashing.

Scratch tables are Parquet in the shared folder that the session names in ``spark.checkpoint.dir`` (see
``sources.store``); they cut lineage: a lost executor costs a reread, not a recomputation.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwire.sources.store import cut, remove, scratch_path

__all__ = ["Bounded", "Scratch", "cut", "id_text", "partitions", "read_table", "scratch_path", "sorted_groups", "tidied"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), null texts empty; other columns, whatever their names, do not reach the operator."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


class Scratch:
    """Scratch tables that can be removed before the session ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, name))
        return cut(df, name, self.paths[-1])

    def remove(self, but: int = 0) -> None:
        """All tables but the last ``but`` of them."""
        gone, self.paths = self.paths[: len(self.paths) - but], self.paths[len(self.paths) - but :]
        for path in gone:
            remove(self.spark, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Successive rows with equal first ``keys`` columns, of sorted batches."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(k).to_numpy() for k in range(keys)]
        starts = np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in cols], axis=0)))).tolist()
        for s, e in zip(starts, [*starts[1:], n], strict=True):
            key = tuple(int(c[s]) for c in cols)
            if held and key != now:
                yield pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def tidied(run):
    """A worker's function over batches, after which what it has freed goes back to the system: workers outlive their tasks."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # where the C library isn't glibc
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return go


class Bounded(dict):
    """A cache of at most ``cap`` entries with keys of at most ``longest`` characters or bytes, so its memory is bounded too.

    Frequent keys come first, so they are the ones that it holds; a longer key's value is made anew each time.
    """

    def __init__(self, make, cap: int = 400_000, longest: int = 64):
        super().__init__()
        self.make, self.cap, self.longest = make, cap, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.cap and len(key) <= self.longest:
            self[key] = value
        return value
