"""Line dedup: range-partitioned line hashes, secondary sort by document and position, keep bitmaps instead of text.

1. Every document emits one row per distinct line key: 128-bit hash, document, positions. A key is the line without
   white space at its ends, A-Z lower-cased; empty keys are never dropped. Rows repeated outright emit theirs once, with
   their number.
2. Rows are range-partitioned and sorted by (hash, document), so even a line that a third of all documents hold is dealt
   over many partitions. Each partition is streamed once: a run of equal hashes is settled as soon as it has
   ``min_docs`` documents, with at most that many rows in memory. Only a partition's first and last runs may go on
   elsewhere; they leave at most ``2 * min_docs`` edge rows, which one small aggregate settles.
3. Dropped positions are gathered by document into a compressed bitmap (bit 1: keep the line); a document that loses no
   line has none. Texts meet their bitmaps by a join that leaves the texts where they are while the bitmaps together are
   within ``BROADCAST_BYTES``; beyond that both sides are shuffled.

``mode="all"`` drops every line whose key is in at least ``min_docs`` documents; ``mode="first"`` keeps the first
occurrence, by document and position, of every key.

Defined results: a null or empty text has one empty line, which stays; each input row counts as a document, and repeated
rows get equal bitmaps; null doc_ids are documents like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwire.llm.common import cut, id_text, partitions

WHITE = b" \t\n\x0b\x0c\r"
#: Bitmaps are broadcast up to this size, 64 bytes a row beside their own bytes counted.
BROADCAST_BYTES = 32_000_000
#: Repeated rows are broadcast up to this number of different ones (24 bytes each).
BROADCAST_REPEATS = 500_000
_DROPPED = "doc_id long, rid long, pos binary, h1 long, h2 long, n int"


def line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, rid, text, times) to a row for each distinct non-empty key of each document."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    for batch in batches:
        docs, rids = batch.column(0), batch.column(1)
        at, hashes, where = [], [], []
        for i, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
            own: dict[bytes, list[int]] = {}
            for pos, line in enumerate(text.split(b"\n")):
                if key := line.strip(WHITE).lower():
                    own.setdefault(digest(key), []).append(pos)
            at.extend([i] * len(own))
            hashes.extend(own)
            where.extend(np.array(p, np.uint32).tobytes() for p in own.values())
        h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
        take = pa.array(at, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [docs.take(take), rids.take(take), pa.array(where, pa.binary()), pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column(3).take(take)], ["doc_id", "rid", "pos", "h1", "h2", "times"]
        )


def _stream(min_docs: int, mode: str):
    """Over one sorted partition: rows to drop, and the edge rows of its first and last runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, pend, held, count, first = None, [], [], 0, True  # of the run that is open; pend: its rows while it isn't settled, held: how often each is there

        def rest(pos: bytes) -> bytes:
            return pos[4:]

        def close(last: bool) -> None:
            if key is None or not (first or last):
                return
            if mode == "first":
                out.append((*pend[0], *key, 1))
            elif count >= min_docs:
                out.append((None, None, None, *key, min_docs))
            else:
                out.extend((*row, *key, n) for row, n in zip(pend, held, strict=True))

        def flush() -> pa.RecordBatch:
            cols = zip(*out, strict=True) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32())
            made = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "rid", "pos", "h1", "h2", "n"])
            out.clear()
            return made

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2, times = (batch.column(k).to_numpy() for k in (3, 4, 5))
            starts = np.flatnonzero(np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))))
            ends = np.append(starts[1:], n)
            doc, rid, pos = (batch.column(k).to_pylist() for k in range(3))
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                now = (int(h1[s]), int(h2[s]))
                if now != key:
                    close(False)
                    first = key is None
                    key, pend, held, count = now, [], [], 0
                if mode == "first":
                    if not count:
                        pend = [(doc[s], rid[s], pos[s])]
                        if not first and rest(pos[s]):
                            out.append((doc[s], rid[s], rest(pos[s]), None, None, 0))
                    out.extend((doc[i], rid[i], pos[i], None, None, 0) for i in range(s + (not count), e))
                    count += e - s
                    continue
                count += int(times[s:e].sum())
                if count >= min_docs:
                    out.extend((*row, None, None, 0) for row in pend)
                    out.extend((doc[i], rid[i], pos[i], None, None, 0) for i in range(s, e))
                    pend, held = [], []
                else:
                    pend.extend((doc[i], rid[i], pos[i]) for i in range(s, e))
                    held.extend(times[s:e].tolist())
            if out:
                yield flush()
        close(True)
        yield flush()

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        maps, dropped = [], []
        for n, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if not gone:
                maps.append(None)
                dropped.append(0)
                continue
            keep = np.ones(n, bool)
            for pos in gone:
                keep[np.frombuffer(pos, np.uint32)] = False
            maps.append(pack(np.packbits(keep).tobytes()))
            dropped.append(int(n - keep.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())], ["doc_id", "rid", "n_lines", "n_dropped", "bitmap"]
        )


def _once(docs: DataFrame, min_docs: int) -> DataFrame:
    """``docs`` with ``times``, of rows repeated outright one; more than ``min_docs`` of them count as so many."""
    repeated = cut(docs.groupBy("doc_id", "rid").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("d"), F.col("rid").alias("r"), "n"), "repeated-rows")
    if repeated.isEmpty():
        return docs.withColumn("times", F.lit(1))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rid") == F.col("r"))
    repeated = F.broadcast(repeated) if repeated.count() <= BROADCAST_REPEATS else repeated
    alone = docs.join(repeated, same, "left_anti").withColumn("times", F.lit(1))
    one = docs.join(repeated, same).groupBy("doc_id", "rid").agg(F.first("text").alias("text"), F.least(F.max("n"), F.lit(min_docs)).cast("int").alias("times"))
    return alone.unionByName(one)


def n_lines(text) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")


def line_dedup(docs: DataFrame, min_docs: int = 10, mode: str = "all", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, rid (xxhash64 of the text), n_lines, n_dropped, bitmap (zstd of packed bits; null where every line stays)."""
    if mode not in ("all", "first") or min_docs < 1:
        raise ValueError("mode is 'all' or 'first', min_docs at least 1")
    docs = id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("rid"), "text")
    order = ["h1", "h2", "doc_id", "rid"]
    keys = cut(_once(docs, min_docs).mapInArrow(line_keys, "doc_id long, rid long, pos binary, h1 long, h2 long, times int"), "line-keys")
    dealt = keys.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    seen = cut(dealt.mapInArrow(_stream(min_docs, mode), _DROPPED), "line-runs")
    edge, place = seen.filter("h1 is not null"), ["doc_id", "rid", "pos"]
    if mode == "all":
        total = edge.groupBy("h1", "h2").agg(F.sum("n").alias("total")).filter(F.col("total") >= min_docs)
        late = edge.filter("pos is not null").join(total, ["h1", "h2"], "left_semi").select(*place)
    else:
        start = edge.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "rid")).alias("start"))
        own = F.when(F.struct("doc_id", "rid").eqNullSafe(F.col("start")), F.expr("substring(pos, 5)")).otherwise(F.col("pos"))
        late = edge.join(start, ["h1", "h2"]).select("doc_id", "rid", own.alias("pos"))
    gone = seen.filter("h1 is null").select(*place).unionByName(late)
    gone = gone.groupBy("doc_id", "rid").agg(F.collect_set("pos").alias("gone"))
    lines = docs.select("doc_id", "rid", n_lines("text").alias("n_lines")).distinct()
    both = lines.alias("a").join(gone.alias("b"), F.expr("a.doc_id <=> b.doc_id and a.rid = b.rid"), "left").select("a.doc_id", "a.rid", "n_lines", "gone")
    return both.mapInArrow(_bitmaps, "doc_id long, rid long, n_lines long, n_dropped long, bitmap binary")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for text, n, bitmap in zip(*(batch.column(k).to_pylist() for k in (3, 1, 4)), strict=True):
            if bitmap is None:
                out.append(text)
                continue
            keep = np.unpackbits(np.frombuffer(unpack(bitmap), np.uint8), count=n)
            out.append("\n".join([line for line, k in zip(text.split("\n"), keep, strict=True) if k]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_text"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text of every row of ``docs``; a document without a bitmap keeps all its lines."""
    docs = id_text(docs, id_col, text_col).withColumn("rid", F.xxhash64("text"))
    losing = cut(bitmaps.filter("bitmap is not null").select("doc_id", "rid", "n_dropped", "bitmap"), "bitmaps")
    size = losing.agg(F.coalesce(F.sum(F.octet_length("bitmap") + 64), F.lit(0))).first()[0]
    few = size <= BROADCAST_BYTES
    both = docs.alias("a").join((F.broadcast(losing) if few else losing).alias("b"), F.expr("a.doc_id <=> b.doc_id and a.rid = b.rid"), "left")
    both = both.select("a.doc_id", n_lines("text").alias("n_lines"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "text", "bitmap")
    kept = lambda rows: rows.mapInArrow(_kept, "doc_id long, n_lines long, n_dropped long, kept_text string")
    if not few:
        return kept(both)
    whole = both.filter("bitmap is null").select("doc_id", "n_lines", "n_dropped", F.col("text").alias("kept_text"))
    return whole.unionByName(kept(both.filter("bitmap is not null")))  # only texts that lose lines go to the Python workers
