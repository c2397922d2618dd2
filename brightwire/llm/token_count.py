"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are emitted.

A word's symbols are a doubly linked list; a heap holds the ranks of its adjacent pairs. The lowest rank (leftmost of
equal ones) is popped and merged until no pair is left; the count is the symbols at first minus the merges, O(n log n)
for a word of n bytes. The counts of frequent words and white-space-bounded pieces are cached within a size bound.

Semantics are those of a byte-level BPE ``tokenizer.json``: special tokens inside a text are cut out first (one token
each), the rest is split by the byte-level pattern, and each match is merged by the file's pair ranks.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted alike; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwire.llm.common import Bounded, id_text

#: White_Space of the Unicode standard, as a character class (fixed values). Python's own class also has U+001C to U+001F, which these patterns do not.
WHITE_SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The split of byte-level BPE before the merges (a fixed value).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bits of a token id, and of a byte's position in a word: a text has fewer than 2^31 bytes.
_SHIFT = 32


def byte_symbols() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return {b: chr(b if b in shown else next(spare)) for b in range(256)}


class MergeCounter:
    """Counts the tokens of a text under one byte-level BPE file."""

    def __init__(self, path: str, words: int = 400_000, pieces: int = 400_000):
        import re

        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.first = [vocab[c] for _, c in sorted(byte_symbols().items())]
        self.pairs: dict[int, int] = {}  # left, right to rank, merged
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[left] << _SHIFT | vocab[right]] = rank << _SHIFT | vocab[left + right]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(BYTE_LEVEL)
        # a token never reaches over an edge between white space and other text, but for one space before it
        self.parts = re.compile(rf" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]").findall
        self.words = Bounded(self.merge, words)
        self.pieces = Bounded(self.piece, pieces)

    def merge(self, word: str) -> int:
        data, first, pairs = word.encode(), self.first, self.pairs
        n = len(data)
        if n < 2:
            return n
        symbol = [first[b] for b in data]
        heap = [(p >> _SHIFT) << _SHIFT | i for i in range(n - 1) if (p := pairs.get(symbol[i] << _SHIFT | symbol[i + 1])) is not None]
        heapify(heap)
        after, before, count, mask = [*range(1, n), -1], [*range(-1, n - 1)], n, (1 << _SHIFT) - 1
        while heap:
            top = heappop(heap)
            i, rank = top & mask, top >> _SHIFT
            j = after[i]
            if symbol[i] < 0 or j < 0 or (p := pairs.get(symbol[i] << _SHIFT | symbol[j])) is None or p >> _SHIFT != rank:
                continue  # the pair has gone since it was pushed
            symbol[i], symbol[j] = p & mask, -1
            k = after[i] = after[j]
            count -= 1
            if k >= 0:
                before[k] = i
                if (p := pairs.get(symbol[i] << _SHIFT | symbol[k])) is not None:
                    heappush(heap, (p >> _SHIFT) << _SHIFT | i)
            if (h := before[i]) >= 0 and (p := pairs.get(symbol[h] << _SHIFT | symbol[i])) is not None:
                heappush(heap, (p >> _SHIFT) << _SHIFT | h)
        return count

    def piece(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.split.findall(text)))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return sum(map(self.pieces.__getitem__, self.parts(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.pieces.__getitem__, self.parts(p))) for p in parts)


_counters: dict[str, MergeCounter] = {}


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(path) or _counters.setdefault(path, MergeCounter(path))
        for batch in batches:
            counts = [counter.count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row. ``path``: a byte-level BPE tokenizer.json that every executor can open."""
    docs = id_text(docs, id_col, text_col).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return docs.mapInArrow(_counted(path), "doc_id long, n_bytes long, n_tokens long")
