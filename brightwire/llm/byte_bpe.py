"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Text is turned into an array of codepoint classes; a small automaton over those classes marks where tokens begin, without
a regular expression. The automaton is run as a scan of transition functions, whose composition is associative: the text
is cut into rows, every row composes the functions of its characters for all states at once, a prefix scan over the rows
composes those, and a replay from each row's known state marks the edges. The slices between edges feed a cached pair
merging by ranks. ``encode`` keeps the character offset of every slice and the number of ids it gave, so ids can be
mapped back to the text.

The automaton is the usual byte-level split: contractions, an optional single space before a run of letters, numbers or
other characters, and runs of white space that leave their last character to what follows.

Defined results: a null or empty text has no ids; repeated rows are encoded alike, with null doc_ids too; an empty table
gives no rows; other columns are ignored. Memory is bounded by the text and its ids: long texts are scanned in segments.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from brightwire.llm.common import Bounded, id_text

# Classes of codepoints; APOSTROPHE, SPACE and WHITE are refined by what follows them.
LETTER, NUMBER, OTHER, SPACE, WHITE, APOSTROPHE = range(6)
# Input symbols of the automaton.
I_LETTER, I_NUMBER, I_OTHER, I_SHORT, I_LONG, I_RUN, I_PREFIX, I_LAST, I_EDGE = range(9)
# States: a token has ended; in letters; in numbers; in others; after a prefix space; in white space; 1 or 2 letters of a contraction left.
S_END, S_LETTER, S_NUMBER, S_OTHER, S_PREFIX, S_RUN, S_ONE, S_TWO = range(8)
#: Codepoints with the property White_Space (fixed values).
WHITE_POINTS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Columns of a row of the scan.
WIDTH = 64
#: Characters of a text, about, that are scanned at once: the arrays take some 100 bytes a character.
SEGMENT = 1_000_000


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, 1 where a token begins), both by symbol * 8 + state."""
    step, begins = np.zeros((9, 8), np.uint8), np.ones((9, 8), np.uint8)
    for symbol, state in ((I_LETTER, S_LETTER), (I_NUMBER, S_NUMBER), (I_OTHER, S_OTHER)):
        step[symbol] = state
        begins[symbol, [state, S_PREFIX]] = 0
    step[I_LETTER, S_TWO], begins[I_LETTER, S_TWO] = S_ONE, 0
    step[I_LETTER, S_ONE], begins[I_LETTER, S_ONE] = S_END, 0
    for symbol, state in ((I_SHORT, S_ONE), (I_LONG, S_TWO)):
        step[symbol] = state
        step[symbol, [S_OTHER, S_PREFIX]] = S_OTHER
        begins[symbol, [S_OTHER, S_PREFIX]] = 0
    step[I_RUN], begins[I_RUN, S_RUN] = S_RUN, 0
    step[I_PREFIX], step[I_LAST], step[I_EDGE] = S_PREFIX, S_END, S_END
    return step.ravel(), begins.ravel()


STEP, BEGINS = _automaton()
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every codepoint, made once a worker."""
    if not _classes:
        import unicodedata

        major = {"L": LETTER, "N": NUMBER}
        table = np.array([major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        table[list(WHITE_POINTS)] = WHITE
        table[0x20], table[0x27] = SPACE, APOSTROPHE
        _classes.append(table)
    return _classes[0]


def symbols(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Input symbols of codepoints; ``edges`` are the places that separate texts."""
    kind = classes()[points]
    kind[edges] = 255
    after = np.append(kind[1:], 255)
    out = np.array([I_LETTER, I_NUMBER, I_OTHER, I_PREFIX, I_LAST, I_OTHER], np.uint8)[np.minimum(kind, 5)]
    blank = (kind == SPACE) | (kind == WHITE)
    out[blank & ((after == SPACE) | (after == WHITE) | (after == 255))] = I_RUN
    out[edges] = I_EDGE
    at = np.flatnonzero(kind == APOSTROPHE)
    if len(at):
        padded = np.append(points, [0, 0])
        padded[edges] = 0
        one, two = padded[at + 1], padded[at + 2]
        out[at[np.isin(one, [ord(c) for c in "stmd"])]] = I_SHORT
        for a, b in ("re", "ve", "ll"):
            out[at[(one == ord(a)) & (two == ord(b))]] = I_LONG
    return out


def scan(inputs: np.ndarray) -> np.ndarray:
    """1 at every place where a token begins; the automaton starts in S_END."""
    n = len(inputs)
    rows = -(-n // WIDTH)
    grid = np.full(rows * WIDTH, I_EDGE, np.uint8)
    grid[:n] = inputs
    grid = np.ascontiguousarray(grid.reshape(rows, WIDTH).T).astype(np.intp) * 8
    made = np.broadcast_to(np.arange(8, dtype=np.uint8), (rows, 8))  # each row's function, from the state before it
    for column in grid:
        made = STEP[column[:, None] + made]
    gap = 1
    made = np.array(made)
    while gap < rows:  # composition is associative: prefixes of 1, 2, 4, ... rows
        made[gap:] = np.take_along_axis(made[gap:], made[:-gap].astype(np.intp), axis=1)
        gap *= 2
    state = np.concatenate(([S_END], made[:-1, S_END])).astype(np.uint8)
    begins = np.empty((WIDTH, rows), np.uint8)
    for k, column in enumerate(grid):
        key = column + state
        begins[k] = BEGINS[key]
        state = STEP[key]
    return begins.T.ravel()[:n]


def token_slices(texts: list[str]) -> list[tuple[list[str], np.ndarray]]:
    """For each text: its pre-tokens, and the character offset at which each begins."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    edges = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = np.flatnonzero(scan(symbols(points, edges)))  # an edge begins a token of its own
    cut = np.searchsorted(starts, edges).tolist()
    places, out, first, base = starts.tolist(), [], 0, 0
    for text, last in zip(texts, cut, strict=True):
        own = places[first : last + 1]
        out.append(([joined[a:b] for a, b in pairwise(own)], starts[first:last] - base))
        first, base = last + 1, base + len(text) + 1
    return out


def segments(text: str) -> list[str]:
    """A long text in parts of about ``SEGMENT`` characters, cut where white space follows something else: a token always begins there, and what precedes it doesn't look further."""
    import re

    out, at, cut = [], 0, re.compile("(?<=[^{0}])[{0}]".format("".join(map(chr, WHITE_POINTS)))).search
    while len(text) - at > SEGMENT and (found := cut(text, at + SEGMENT)):
        out.append(text[at : found.start()])
        at = found.start()
    return [*out, text[at:]]


class RankCoder:
    """Ids by merge ranks, as a rank file (base64 token, rank) gives them."""

    def __init__(self, path: str, cap: int = 400_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.shown = [b"%d" % i for i in range(len(self.bytes))]
        self.words = Bounded(self.merge, cap)

    def merge(self, word: str) -> bytes:
        """Little-endian 32-bit ids of one pre-token: a heap of pair ranks over a linked list of byte spans."""
        data, ranks = word.encode(), self.ranks
        if (whole := ranks.get(data)) is not None:
            return whole.to_bytes(4, "little")
        n = len(data)
        ends, before = [*range(1, n + 1)], [*range(-1, n)]  # ends[i]: where the span that begins at i ends, 0 once merged away
        heap = [(r << 32) | i for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            if not (j := ends[i]) or j >= n or ranks.get(data[i : ends[j]]) != top >> 32:
                continue  # the pair has gone since it was pushed
            k = ends[i] = ends[j]
            ends[j] = 0
            if k < n:
                before[k] = i
                if (r := ranks.get(data[i : ends[k]])) is not None:
                    heappush(heap, (r << 32) | i)
            if (h := before[i]) >= 0 and (r := ranks.get(data[h:k])) is not None:
                heappush(heap, (r << 32) | h)
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : ends[i]]])
            i = ends[i]
        return np.array(out, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text: ids, the character offsets of its pre-tokens, the number of ids of each pre-token."""
        for block in _blocks(texts):
            if len(block) > 1 or len(block[0]) <= SEGMENT:
                yield from self._encode(block)
                continue
            parts = segments(block[0])
            made = [next(self._encode([p])) for p in parts]
            base = np.cumsum([0, *map(len, parts)])
            yield np.concatenate([m[0] for m in made]), np.concatenate([m[1] + b for m, b in zip(made, base, strict=False)]), np.concatenate([m[2] for m in made])

    def _encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for pieces, offsets in token_slices(texts):
            parts = list(map(self.words.__getitem__, pieces))
            yield np.frombuffer(b"".join(parts), "<u4"), offsets, np.fromiter(map(len, parts), np.int64, len(parts)) >> 2

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_coders: dict[str, RankCoder] = {}


def coder(path: str) -> RankCoder:
    return _coders.get(path) or _coders.setdefault(path, RankCoder(path))


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    """Successive texts of about ``SEGMENT`` characters together; a longer one is alone."""
    own, n = [], 0
    for t in texts:
        if own and n + len(t) > SEGMENT:
            yield own
            own, n = [], 0
        own.append(t)
        n += len(t)
    if own:
        yield own


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offsets, counts = [], [], []
            for own, at, n in coder(path).encode(batch.column(1).to_pylist()):
                ids.append(own.astype(np.int32))
                offsets.append(at.astype(np.int32))
                counts.append(n.astype(np.int32))
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, lists) for c in (ids, offsets, counts))], ["doc_id", "ids", "offsets", "piece_ids"])

    return run


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, offsets (character at which each pre-token begins), piece_ids (ids of each pre-token)."""
    return id_text(docs, id_col, text_col).mapInArrow(_encoded(path), "doc_id long, ids array<int>, offsets array<int>, piece_ids array<int>")


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [coder(path).decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "data"])

    return run


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, data (bytes) of (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(path), "doc_id long, data binary")


def _ranges(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            rows = []
            for ids, offsets, counts, first, last in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
                first, last = max(0, min(first, len(ids))), max(0, min(last, len(ids)))
                if first >= last:
                    rows.append((b"", None, None))
                    continue
                ends = np.cumsum(counts)  # ids up to the end of each pre-token
                a, b = np.searchsorted(ends, [first, last - 1], "right").tolist()
                before = int(ends[a] - counts[a])
                head = own.decode(ids[before:first])  # of the first pre-token, what lies before the range
                begin = offsets[a] + len(head.decode(errors="ignore"))
                rows.append((own.decode(ids[first:last]), begin, offsets[b + 1] if b + 1 < len(offsets) else None))
            data, begin, end = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary()), pa.array(begin, pa.int64()), pa.array(end, pa.int64())], ["doc_id", "data", "begin", "upto"])

    return run


def decode_range(encoded: DataFrame, path: str, first: Column, last: Column) -> DataFrame:
    """doc_id, data, begin, upto of the ids from ``first`` up to before ``last`` (columns of ``encoded``) of each document.

    data: the bytes of these ids only. begin: the character in which they begin, by the offset of its pre-token; upto: where the last pre-token
    that they reach ends (null at the text's end). Ids beyond the ends are left out; an empty range has no bytes and null places.
    """
    rows = encoded.select("doc_id", "ids", "offsets", "piece_ids", first.cast("int").alias("first"), last.cast("int").alias("last"))
    return rows.mapInArrow(_ranges(path), "doc_id long, data binary, begin long, upto long")


def _digested(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in batches:
            n, shown, back = [], [], []
            for ids, _, _ in own.encode(batch.column(1).to_pylist()):
                ids = ids.tolist()
                n.append(len(ids))
                shown.append(hashlib.sha256(b" ".join(map(own.shown.__getitem__, ids))).hexdigest())
                back.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(shown), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, and its ids decoded, in one pass."""
    return id_text(docs, id_col, text_col).mapInArrow(_digested(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
