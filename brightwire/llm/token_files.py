"""Token-id files by plane shuffling.

The ids of all documents, in ascending doc_id order, are cut into blocks of ``block`` ids. Each block is transposed into
byte planes (or bit planes), every plane is compressed with zstandard, and the file's footer indexes its blocks and
documents: ``TokenFile.ids`` opens only the blocks that hold the ids asked for.

A file ends after ``FILE_BLOCKS`` blocks or ``FILE_DOCS`` documents, so it stays below some 130 MB however much a task
writes and however long a document is; a document may go on in the next file.

Layout of a file (integers little-endian; every frame is followed by one line-feed byte, which the sink adds)::

    block frame   for each plane: u32 length, zstd bytes
    empty frames  in files that end early, but for a task's last one, so that every file has FILE_BLOCKS + 2 frames
    footer frame  zstd of [blocks: offset u64, bytes u64, first id u64, ids u64]
                  [documents: id i64, null u8, goes on u8, ids here u64, ids in earlier files u64]
    trailer       footer offset u64, footer bytes u64, blocks u64, documents u64, planes u64, magic BWTOKEN2, line feed

Files are written by Spark's own committed text sink (a column of raw bytes, a frame a row, rolled over by its count of
rows), so any store that Spark can write holds them, a lost executor's attempt leaves nothing behind, and part numbers
follow the range partitions, hence doc_id order.

Defined results: a null or empty text has only the end id; null doc_ids come first; rows with equal doc_ids are ordered
by a hash of their texts, so even a doc_id that many rows repeat is dealt over partitions; an empty table gives no
documents; other columns are ignored.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightwire.llm.common import cut, id_text, partitions, tidied
from brightwire.llm.word_ids import encoder, in_blocks

MAGIC = b"BWTOKEN2"
FILE_BLOCKS, FILE_DOCS = 512, 1_000_000
TRAILER = struct.Struct("<QQQQQ8s")
_INDEX = np.dtype([("offset", "<u8"), ("size", "<u8"), ("first", "<u8"), ("n", "<u8")])
_DOCS = np.dtype([("doc", "<i8"), ("null", "u1"), ("more", "u1"), ("n", "<u8"), ("before", "<u8")])


def pack_block(ids: np.ndarray, planes: int, level: int = 3) -> bytes:
    """planes: 4 byte planes or 32 bit planes."""
    import zstandard

    ids = np.ascontiguousarray(ids, "<u4")
    table = ids.view(np.uint8).reshape(-1, 4)
    if planes == 32:
        rows = np.packbits(np.unpackbits(table, axis=1, bitorder="little"), axis=0).T
    elif planes == 4:
        rows = table.T
    else:
        raise ValueError("planes is 4 (bytes) or 32 (bits)")
    squeeze = zstandard.ZstdCompressor(level=level).compress
    parts = [squeeze(np.ascontiguousarray(r).tobytes()) for r in rows]
    return b"".join(struct.pack("<I", len(p)) + p for p in parts)


def unpack_block(data: bytes, n: int, planes: int) -> np.ndarray:
    import zstandard

    expand, at, rows = zstandard.ZstdDecompressor().decompress, 0, []
    for _ in range(planes):
        (size,) = struct.unpack_from("<I", data, at)
        rows.append(np.frombuffer(expand(data[at + 4 : at + 4 + size]), np.uint8))
        at += 4 + size
    table = np.stack(rows)
    if planes == 32:
        table = np.packbits(np.unpackbits(table, axis=1, count=n), axis=0, bitorder="little")
    return np.ascontiguousarray(table.T).view("<u4").ravel()


class FileWriter:
    """Frames of successive files: ``add`` documents in order, then ``close``."""

    def __init__(self, block: int, planes: int, file_blocks: int = FILE_BLOCKS, file_docs: int = FILE_DOCS):
        self.block, self.planes, self.file_blocks, self.file_docs = block, planes, file_blocks, file_docs
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self._open([])

    def _open(self, docs: list[list]) -> None:
        self.at = self.first = 0
        self.index: list[tuple] = []
        self.docs = docs

    def add(self, doc_id: int | None, ids: bytes) -> list[bytes]:
        self.docs.append([doc_id or 0, doc_id is None, False, len(ids) // 4, 0])
        self.held.append(np.frombuffer(ids, "<u4"))
        self.n_held += len(ids) // 4
        out = []
        while self.n_held >= self.block:
            out.append(self._block())
            if len(self.index) == self.file_blocks:
                out.extend(self._end())
        if len(self.docs) >= self.file_docs:
            out.extend(self._end(True))
        return out

    def _block(self) -> bytes:
        ids = np.concatenate(self.held) if len(self.held) > 1 else self.held[0]
        now, rest = ids[: self.block], ids[self.block :]
        frame = pack_block(now, self.planes)
        self.index.append((self.at, len(frame), self.first, len(now)))
        self.at += len(frame) + 1
        self.first += len(now)
        self.held, self.n_held = [rest], len(rest)
        return frame

    def _end(self, pad: bool = False) -> list[bytes]:
        """The file's last frames; what is held by now belongs to the last document, which goes on in the next file."""
        import zstandard

        out, next_docs = [], []
        if pad:  # no whole block is held
            out = [self._block()] if self.n_held else []
            empty = self.file_blocks - len(self.index)
            out.extend([b""] * empty)
            self.at += empty
        elif self.n_held:
            doc, null, _, n, before = self.docs[-1]
            self.docs[-1] = [doc, null, True, n - self.n_held, before]
            next_docs = [[doc, null, False, self.n_held, before + n - self.n_held]]
        tables = np.array(self.index, _INDEX).tobytes() + np.array([tuple(d) for d in self.docs], _DOCS).tobytes()
        footer = zstandard.ZstdCompressor(level=3).compress(tables)
        out.extend([footer, TRAILER.pack(self.at, len(footer), len(self.index), len(self.docs), self.planes, MAGIC)])
        self._open(next_docs)
        return out

    def close(self) -> list[bytes]:
        """The last file, if it has documents."""
        if not self.docs:
            return []
        return ([self._block()] if self.n_held else []) + self._end()


class TokenFile:
    """A file opened for reading: its index, and any range of its ids; ``f`` is seekable."""

    def __init__(self, f: BinaryIO):
        import zstandard

        f.seek(-TRAILER.size - 1, io.SEEK_END)
        at, size, n_blocks, n_docs, self.planes, magic = TRAILER.unpack(f.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        f.seek(at)
        tables = zstandard.ZstdDecompressor().decompress(f.read(size))
        self.f, self.index = f, np.frombuffer(tables, _INDEX, n_blocks)
        #: (id, None where it is null; whether it goes on in the next file; its ids here; its ids in earlier files)
        self.docs = [(None if null else doc, bool(more), n, before) for doc, null, more, n, before in np.frombuffer(tables, _DOCS, n_docs, n_blocks * _INDEX.itemsize).tolist()]

    def block(self, k: int) -> np.ndarray:
        offset, size, _, n = self.index[k].tolist()
        self.f.seek(offset)
        return unpack_block(self.f.read(size), n, self.planes)

    def blocks(self) -> Iterator[np.ndarray]:
        return map(self.block, range(len(self.index)))

    def ids(self, first: int, n: int) -> np.ndarray:
        """``n`` ids from the file's id ``first`` on; only the blocks that hold them are read."""
        begin = self.index["first"].astype(np.int64)
        a, b = int(np.searchsorted(begin, first, "right")) - 1, int(np.searchsorted(begin, first + n, "left"))
        if n <= 0 or a < 0:
            return np.zeros(0, "<u4")
        found = np.concatenate([self.block(k) for k in range(a, b)])
        return found[first - begin[a] :][:n]


def _encode(path: str, end: int | None, block: int, planes: int, file_blocks: int, file_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, tail = FileWriter(block, planes, file_blocks, file_docs), b"" if end is None else struct.pack("<I", end)
        send = lambda frames: pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in in_blocks(batch.column(1)):
                for k, own in enumerate(encoder(path).encode(texts), first):
                    if frames := writer.add(ids[k], own + tail):
                        yield send(frames)
        if frames := writer.close():
            yield send(frames)

    return run


def write_token_files(docs: DataFrame, path: str, target: str, end: int | None = 1, block: int = 1 << 16, planes: int = 4, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text with the tokenizers file ``path``, append ``end``, write the files under ``target``."""
    order = [F.asc_nulls_first("doc_id"), "h", "tie"]
    docs = id_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("tie"))
    dealt = docs.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("doc_id", "text")
    frames = dealt.mapInArrow(tidied(_encode(path, end, block, planes, FILE_BLOCKS, FILE_DOCS)), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_BLOCKS + 2).text(target, lineSep="\n")


_NAMES = ["file", "doc_id", "before", "whole", "start", "n_tokens", "ids"]
_PIECES = "file string, doc_id long, before long, whole boolean, start long, n_tokens long, ids binary"


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's ids in each file, decoded block by block."""
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
    send = lambda out: pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], _NAMES)
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if not len(data.as_buffer()):
                continue
            file = TokenFile(pa.BufferReader(data.as_buffer()))
            blocks, held, out, start, size = file.blocks(), np.zeros(0, "<u4"), [], 0, 0
            for doc, more, n, before in file.docs:
                parts, have = [held], len(held)
                while have < n:
                    parts.append(next(blocks))
                    have += len(parts[-1])
                ids = np.concatenate(parts) if len(parts) > 1 else held
                own, held = ids[:n], ids[n:]
                out.append((path, doc, before, not (more or before), start, n, own.tobytes()))
                start, size = start + n, size + n
                if len(out) == 1000 or size > 4_000_000:
                    yield send(out)
                    out, size = [], 0
            if out:
                yield send(out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_documents``, with the sums of whole documents in place of their ids."""
    for batch in _documents(batches):
        whole, ids = batch.column(3).to_pylist(), batch.column(6)
        crc = pa.array([zlib.crc32(x.as_buffer()) if w else None for w, x in zip(whole, ids, strict=True)], pa.int64())
        rest = pa.array([None if w else x.as_py() for w, x in zip(whole, ids, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:6], rest, crc], [*_NAMES, "ids_crc32"])


def _files(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(target).select("path", "content")


def _placed(pieces: DataFrame) -> DataFrame:
    """Starts within files to starts within the corpus. Files are few: one of them has up to FILE_BLOCKS blocks."""
    pieces = pieces.withColumn("part", F.regexp_extract("file", r"part-(\d+)", 1).cast("long")).withColumn("roll", F.regexp_extract("file", r"-c(\d+)\.", 1).cast("long"))
    files = pieces.groupBy("part", "roll").agg(F.sum("n_tokens").alias("total"))
    files = files.withColumn("here", F.sum("total").over(Window.partitionBy("part").orderBy("roll")) - F.col("total"))
    parts = files.groupBy("part").agg(F.sum("total").alias("all"))
    parts = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("earlier"))
    begin = files.join(parts, "part").select("part", "roll", (F.col("here") + F.col("earlier")).alias("begin"))
    return pieces.join(begin, ["part", "roll"]).withColumn("start", F.col("start") + F.col("begin")).drop("part", "roll", "begin", "file")


def _whole(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that lie in one file, and those of several put together."""
    split = pieces.filter("not whole").groupBy((F.col("start") - F.col("before")).alias("start"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("before", "ids"))), lambda p: p["ids"])
    ids = F.aggregate(parts, F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids")
    return pieces.filter("whole"), split.agg(F.first("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), ids)


def read_token_files(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian u32) of every document."""
    whole, rest = _whole(_placed(cut(_files(spark, target).mapInArrow(_documents, _PIECES), "token-ids")))
    names = ["doc_id", "start", "n_tokens", "ids"]
    return whole.select(*names).unionByName(rest.select(*names))


def read_digests(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document."""
    whole, rest = _whole(_placed(cut(_files(spark, target).mapInArrow(_digests, f"{_PIECES}, ids_crc32 long"), "token-digests")))
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return whole.select(*names).unionByName(rest.withColumn("ids_crc32", F.crc32("ids")).select(*names))
