"""Ranked lexical search of a stated set of items against all documents, by sort-based accumulation.

1. Items are cut into terms and dealt into blocks of some ``ITEM_TERMS`` terms; each block is searched by itself, so what a
   task holds of the items is bounded whatever their number is.
2. One pass over the texts writes postings: a row per document with its length and, for terms of the block's items only,
   term numbers and frequencies. Document frequencies and the corpus' sums are aggregates of that table.
3. A pass over the postings scores them. A run of documents is concatenated to flat arrays, every posting gets its impact and
   is repeated for the items that hold its term; the triples' (item, document) are packed into one key, the keys are radix
   sorted by 16-bit digits, and ``numpy.add.reduceat`` sums the runs. A run has at most ``TRIPLES`` triples.
4. Every task keeps the ``k`` best of each item in a heap. These candidates are range-partitioned by (item, document), each
   range keeps the ``k`` best of its items again, and a window ranks what is left: an item's candidates never meet in one
   task before that.

Everything a score needs of a document is in its row, so no document is scored in part, and none is left out.

Defined results: null and empty texts, and texts without terms, are no documents of the corpus' counts and match nothing;
an item without terms, or without matching documents, has no rows; of equal scores smaller doc_ids rank first, null ones
last; rows with equal doc_ids are documents of their own, and so are repeated items; empty tables give no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightwire.llm.common import cut, id_text, partitions, tidied

TOP = 10
#: Terms of a block of items, on average; a task holds a block's terms and their items (some 100 bytes each).
ITEM_TERMS = 200_000
#: Most (item, document, impact) triples that are accumulated at once (one document's at least).
TRIPLES = 2_000_000
#: A null doc_id's place in the order: behind all others.
_NULL = 1 << 63

_SPACE_OR_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and anything beyond ASCII, A-Z lower-cased."""
    return text.translate(_SPACE_OR_LOWER).split()


def weight(df: int, n: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_part(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """100 - 75 + (75 * length * n) div total; beyond 64 bits by Python's integers."""
    if len(lengths) and 75 * n * int(lengths.max()) >= 1 << 63:
        return np.array([25 + 75 * int(x) * n // total for x in lengths], np.int64)
    return 25 + 75 * n * lengths // total


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of unsigned keys: one pass a 16-bit digit, from the lowest (numpy sorts 16-bit numbers by radix)."""
    order = np.arange(len(keys))
    for shift in range(0, int(keys.max()).bit_length() if len(keys) else 0, 16):
        digit = (keys[order] >> np.uint64(shift)).astype(np.uint16)
        if (digit[1:] < digit[:-1]).any():
            order = order[np.argsort(digit, kind="stable")]
    return order


def repeated(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each, ``counts`` of them."""
    return np.repeat(begin - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())


def accumulate(items: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, document, sum of impacts) of each pair that occurs, sorted."""
    keys = items.astype(np.uint64) * np.uint64(n_docs) + docs.astype(np.uint64)
    order = radix_order(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(impacts[order], starts) if len(keys) else np.zeros(0, np.int64)
    return (keys[starts] // np.uint64(n_docs)).astype(np.int64), (keys[starts] % np.uint64(n_docs)).astype(np.int64), sums


class Block:
    """A block's terms and, for each, the items that hold it with their repeats: flat arrays, ``begin`` by term number."""

    def __init__(self, rows: pa.Table):
        self.items, self.ids = rows.column("item_no").to_numpy(), rows.column("item_id").to_pylist()
        terms = rows.column("term").to_pylist()
        self.terms = {t: i for i, t in enumerate(sorted(set(terms)))}
        self.numbers, item = np.unique(self.items, return_inverse=True)
        of = np.fromiter((self.terms[t] for t in terms), np.int64, len(terms))
        order = np.argsort(of, kind="stable")
        self.item, self.times = item[order], rows.column("times").to_numpy()[order]
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(self.terms)))))


class Best:
    """The ``k`` best (score, then smallest document) of each key, in heaps; ``least`` is what a new one must reach."""

    def __init__(self, keys: int, k: int):
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(keys)]
        self.least, self.k = np.ones(keys, np.int64), k

    def add(self, keys: np.ndarray, docs: list[int], scores: np.ndarray) -> None:
        for key, doc, score in zip(keys.tolist(), docs, scores.tolist(), strict=True):
            heap = self.heaps[key]
            if len(heap) < self.k:
                heapq.heappush(heap, (score, -doc))
            else:
                heapq.heappushpop(heap, (score, -doc))
            if len(heap) == self.k:
                self.least[key] = heap[0][0]


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_no, item_id, term, times): a row for each distinct term of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(terms_of(t)) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            at = pa.array([i for i, c in enumerate(found) for _ in c], pa.int32())
            terms, times = [t for c in found for t in c], [n for c in found for n in c.values()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(terms, pa.binary()), pa.array(times, pa.int64())], ["item_no", "item_id", "term", "times"])

    rows = id_text(items, id_col, text_col).select(F.monotonically_increasing_id().alias("item_no"), F.col("doc_id").alias("item_id"), "text")
    return rows.mapInArrow(run, "item_no long, item_id long, term binary, times long")


def postings(docs: DataFrame, block, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, times) of every document with terms; ``block`` is a broadcast ``Block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = block.value.terms
        names = number.keys()
        for batch in batches:
            held, lengths, terms, times, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column(1)):
                own = terms_of(text.as_buffer().to_pybytes())
                if own:
                    counts = Counter(own)
                    met = names & counts.keys()
                    held.append(i)
                    lengths.append(len(own))
                    terms.extend(map(number.__getitem__, met))
                    times.extend(map(counts.__getitem__, met))
                    ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(held, pa.int32())), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    return id_text(docs, id_col, text_col).mapInArrow(tidied(run), "doc_id long, n long, terms array<int>, times array<int>")


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents: first 64, then twice as many each time, up to ``TRIPLES`` triples or 65,536."""
    ends, s, many = np.cumsum(sizes), 0, 64
    while s < len(sizes):
        fits = int(np.searchsorted(ends, (ends[s - 1] if s else 0) + TRIPLES, "right"))
        e = min(len(sizes), s + many, max(fits, s + 1))
        yield s, e
        s, many = e, min(2 * many, 65_536)


def _scored(block, weights, n: int, total: int, k: int):
    """Over postings: each item's ``k`` best documents of this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = block.value, weights.value
        best = Best(len(own.numbers), k)
        for batch in batches:
            docs = [_NULL if d is None else d for d in batch.column(0).to_pylist()]
            m = length_part(batch.column(1).to_numpy(), n, total)
            lists, times = batch.column(2), batch.column(3).flatten().to_numpy().astype(np.int64)
            terms, each = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            doc = np.repeat(np.arange(len(docs)), each)
            impacts = w[terms] * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))
            counts = own.begin[terms + 1] - own.begin[terms]
            first = np.concatenate(([0], np.cumsum(each)))
            for s, e in _runs(np.add.reduceat(np.append(counts, 0), first[:-1]) * (each > 0) if len(docs) else np.zeros(0, np.int64)):
                a, b = first[s], first[e]
                take = repeated(own.begin[terms[a:b]], counts[a:b])
                of = np.repeat(np.arange(a, b), counts[a:b])
                items, at, scores = accumulate(own.item[take], doc[of] - s, impacts[of] * own.times[take], e - s)
                keep = scores >= best.least[items]
                best.add(items[keep], [docs[s + i] for i in at[keep].tolist()], scores[keep])
        numbers = own.numbers.tolist()
        rows = [(numbers[i], None if -d == _NULL else -d, s) for i, heap in enumerate(best.heaps) for s, d in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["item_no", "doc_id", "score"])

    return run


def _narrowed(k: int):
    """Over candidates sorted by item: each item's ``k`` best of this range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, Best(1, k)

        def out() -> pa.RecordBatch:
            rows = [] if now is None else [(now, None if -d == _NULL else -d, s) for s, d in best.heaps[0]]
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["item_no", "doc_id", "score"])

        for batch in batches:
            items = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], items[1:] != items[:-1]))).tolist() if len(items) else []
            for s, e in zip(starts, [*starts[1:], len(items)], strict=False):
                if items[s] != now:
                    yield out()
                    now, best = int(items[s]), Best(1, k)
                docs = [_NULL if d is None else d for d in batch.column(1).slice(s, e - s).to_pylist()]
                best.add(np.zeros(e - s, np.int64), docs, batch.column(2).slice(s, e - s).to_numpy())
        yield out()

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """(item_no, rank, doc_id, score) of candidates of any number."""
    dealt = found.repartitionByRange(partitions(found.sparkSession), "item_no", "doc_id").sortWithinPartitions("item_no")
    narrow = dealt.mapInArrow(_narrowed(k), "item_no long, doc_id long, score long")
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return narrow.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_no", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` highest-scoring documents of each item, all if fewer score above 0."""
    spark = docs.sparkSession
    own = cut(item_terms(items, item_col, item_text), "item-terms")
    blocks, out = math.ceil(own.count() / ITEM_TERMS), None
    for b in range(blocks):
        rows = own.filter(F.pmod(F.xxhash64("item_no"), F.lit(blocks)) == b).toArrow()
        if not rows.num_rows:
            continue
        block = spark.sparkContext.broadcast(Block(rows))
        posts = cut(postings(docs, block, id_col, text_col), "postings")
        n, total = posts.agg(F.count("*"), F.sum("n")).first()
        if not n:
            break
        weights = np.zeros(len(block.value.terms), np.int64)
        for r in posts.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow().to_pylist():  # a row for each of the block's terms at most
            weights[r["term"]] = weight(r["count"], n)
        scored = posts.mapInArrow(tidied(_scored(block, spark.sparkContext.broadcast(weights), n, total, k)), "item_no long, doc_id long, score long")
        found = cut(scored, "candidates")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    names = own.select("item_no", "item_id").distinct()
    return _ranked(out, k).join(names, "item_no").select("item_id", "rank", "doc_id", "score")
