"""Best-fit packing by a grouping genetic algorithm on islands with elite migration.

1. Every document is encoded and cut into pieces of at most ``size`` tokens; only longer documents give several pieces.
   Pieces of exactly ``size`` tokens are sequences of their own.
2. The other pieces are dealt at random over islands of about ``ISLAND`` pieces. An island breeds packings whose genes are
   whole sequences: crossover injects the well-filled sequences of one parent into the other, drops those that hold the
   same pieces, and best-fits the displaced ones; mutation empties the worst sequences. It ends at the lower bound, the
   island's tokens divided by ``size``, or after ``GENERATIONS``.
3. Elites migrate: an island's exactly full sequences, as their piece lengths, go to the next island of the ring, which
   builds them from its own pieces before it breeds again.
4. Each island's sequences that aren't full enough are dealt over fewer islands and packed again, level by level, so
   that the rounding loss of many islands is won back.

Memory is bounded by an island; nothing is collected. Defined results: a null or empty text is one piece with only the end
id; repeated rows are pieces of their own; null doc_ids are packed like others; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import random
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwire.llm.common import cut, id_text, partitions, sorted_groups, tidied
from brightwire.llm.word_ids import encoder, in_blocks

ISLAND, POPULATION, GENERATIONS, ELITES, LEVELS = 8192, 6, 10, 256, 3
#: A sequence filled less than this is packed again with other islands' ones.
FULL_ENOUGH = 0.995
_BITS = 24
_MASK = (1 << _BITS) - 1

_PIECES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut_up(path: str, size: int, end: int):
    tail = struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            docs, out = batch.column(0).to_pylist(), []
            for first, texts in in_blocks(batch.column(1)):
                for k, own in enumerate(encoder(path).encode(texts), first):
                    own += tail
                    for p, at in enumerate(range(0, len(own), 4 * size)):
                        part = own[at : at + 4 * size]
                        out.append((docs[k], p, at // 4, len(part) // 4, zlib.crc32(part)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], _PIECES)

    return run


class Breeder:
    """Packings of the pieces 0 to n - 1 of one island; a packing is a list of sequences, a sequence a list of pieces."""

    def __init__(self, lengths: list[int], size: int, seed: int):
        self.lengths, self.size, self.rng = lengths, size, random.Random(seed)
        self.bound = -(-sum(lengths) // size)

    def fill(self, own: list[int]) -> int:
        return sum(map(self.lengths.__getitem__, own))

    def rank(self, packing: list[list[int]]) -> tuple[int, int]:
        """Lower is better: fewer sequences, then more uneven fills."""
        return len(packing), -sum(self.fill(s) ** 2 for s in packing)

    def best_fit(self, packing: list[list[int]], pieces: list[int]) -> list[list[int]]:
        """Each piece goes where it leaves the least room."""
        room = sorted((self.size - f) << _BITS | i for i, s in enumerate(packing) if (f := self.fill(s)) < self.size)
        for piece in pieces:
            length = self.lengths[piece]
            k = bisect_left(room, length << _BITS)
            if k < len(room):
                top = room.pop(k)
                i, left = top & _MASK, (top >> _BITS) - length
                packing[i].append(piece)
            else:
                i, left = len(packing), self.size - length
                packing.append([piece])
            if left:
                insort(room, left << _BITS | i)
        return packing

    def descending(self, pieces: list[int], jitter: float = 0.0) -> list[int]:
        if not jitter:
            return sorted(pieces, key=lambda p: (-self.lengths[p], p))
        return sorted(pieces, key=lambda p: -self.lengths[p] * (1 + jitter * self.rng.random()))

    def crossover(self, into: list[list[int]], donor: list[list[int]]) -> list[list[int]]:
        """Whole well-filled sequences of ``donor`` replace what holds their pieces; the displaced pieces are best-fitted."""
        well = sorted(donor, key=self.fill, reverse=True)[: max(1, len(donor) // 2)]
        injected = self.rng.sample(well, max(1, len(well) // 2))
        taken = {p for s in injected for p in s}
        kept, displaced = [list(s) for s in injected], []
        for s in into:
            if taken.isdisjoint(s):
                kept.append(list(s))
            else:
                displaced.extend(p for p in s if p not in taken)
        return self.best_fit(kept, self.descending(displaced))

    def mutate(self, packing: list[list[int]]) -> list[list[int]]:
        order = sorted(packing, key=self.fill)
        gone = max(1, len(order) // 20)
        rest = order[gone:]
        self.rng.shuffle(rest)
        extra = len(rest) // 20
        displaced = [p for s in [*order[:gone], *rest[:extra]] for p in s]
        return self.best_fit([list(s) for s in rest[extra:]], self.descending(displaced, 0.3))

    def settle(self, patterns: list[tuple[int, ...]]) -> list[list[int]]:
        """Immigrant patterns (piece lengths of full sequences) built from own pieces while they last; the rest best-fitted."""
        stock = defaultdict(list)
        for p, n in enumerate(self.lengths):
            stock[n].append(p)
        packing = []
        for pattern in patterns:
            need = Counter(pattern)
            for _ in range(min(len(stock[n]) // k for n, k in need.items())):
                packing.append([stock[n].pop() for n in pattern])
        return self.best_fit(packing, self.descending([p for own in stock.values() for p in own]))

    def evolve(self, known: list[list[list[int]]], generations: int = GENERATIONS) -> list[list[int]]:
        everything = list(range(len(self.lengths)))
        population = [*known, self.best_fit([], self.descending(everything))]
        best = min(population, key=self.rank)
        if len(best) <= self.bound:
            return best
        while len(population) < POPULATION:
            population.append(self.best_fit([], self.descending(everything, 0.2 * len(population))))
        for _ in range(generations):
            population.sort(key=self.rank)
            if len(population[0]) <= self.bound:
                break
            parents = population[: POPULATION // 2 + 1]
            children = [self.crossover(*self.rng.sample(parents, 2)) for _ in range(POPULATION // 2)]
            children.append(self.mutate(parents[0]))
            population = [*parents, *children]
        return min(population, key=self.rank)

    def elites(self, packing: list[list[int]]) -> list[tuple[int, ...]]:
        found = {tuple(sorted(map(self.lengths.__getitem__, s), reverse=True)) for s in packing if self.fill(s) == self.size and len(s) > 1}
        return sorted(found)[:ELITES]


#: kind 0: a piece and its sequence on the island; kind 1: an immigrant pattern.
_ISLAND_SCHEMA = f"island long, doc long, kind int, bin int, fill int, pattern array<int>, {_PIECE_SCHEMA}"


def _evolve(size: int, islands: int, level: int):
    """Islands' rows to their best packing and the elites that leave for the next island."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, 1):
            rows = table.to_pylist()
            island = rows[0]["island"]
            pieces = sorted((r for r in rows if r["kind"] == 0), key=lambda r: (-r["length"], r["doc_id"] or 0, r["piece"]))
            patterns = [tuple(r["pattern"]) for r in rows if r["kind"] == 1]
            if not pieces:
                continue
            breeder = Breeder([r["length"] for r in pieces], size, seed=island * 31 + level)
            known = []
            if pieces[0]["bin"] is not None:
                now = defaultdict(list)
                for i, r in enumerate(pieces):
                    now[r["bin"]].append(i)
                known.append(list(now.values()))
            if patterns:
                known.append(breeder.settle(sorted(patterns)))
            best = breeder.evolve(known)
            out = []
            for b, own in enumerate(best):
                fill = breeder.fill(own)
                out.extend(pieces[i] | {"bin": b, "fill": fill} for i in own)
            blank = dict.fromkeys(_PIECES) | {"doc": None, "kind": 1, "bin": None, "fill": None}
            if islands > 1:
                out.extend(blank | {"island": (island + 1) % islands, "pattern": list(p)} for p in breeder.elites(best))
            yield pa.RecordBatch.from_pylist(out, schema=table.schema)

    return run


def _islands(rows: DataFrame, islands: int, size: int, level: int, name: str) -> DataFrame:
    dealt = rows.repartition(partitions(rows.sparkSession), "island").sortWithinPartitions("island", "kind", "doc")
    return cut(dealt.mapInArrow(tidied(_evolve(size, islands, level)), _ISLAND_SCHEMA), name)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (sequence_id, piece order) to offsets."""
    now, at = None, 0
    for batch in batches:
        ids, lengths, out = batch.column(5).to_pylist(), batch.column(3).to_pylist(), []
        for s, n in zip(ids, lengths, strict=True):
            if s != now:
                now, at = s, 0
            out.append(at)
            at += n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*_PIECES, "sequence_id", "offset"])


def cut_up(docs: DataFrame, path: str, size: int = 2048, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; ids by the tokenizers file ``path``, then ``end``."""
    return id_text(docs, id_col, text_col).mapInArrow(tidied(_cut_up(path, size, end)), _PIECE_SCHEMA)


def pack(pieces: DataFrame, size: int = 2048, island: int = ISLAND) -> DataFrame:
    """The pieces, each with its sequence_id and its offset there."""
    pieces = cut(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = pieces.filter(F.col("length") >= size).select(*_PIECES, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    none = {c: F.lit(None).cast(t) for c, t in (("bin", "int"), ("fill", "int"), ("pattern", "array<int>"))}
    rows = pieces.filter(F.col("length") < size).select(F.col("row").alias("doc"), F.lit(0).alias("kind"), *(v.alias(k) for k, v in none.items()), *_PIECES)
    done = []
    for level in range(LEVELS):
        islands = -(-rows.count() // island)
        if not islands:
            break
        dealt = rows.withColumn("island", F.pmod(F.xxhash64("doc", F.lit(level)), F.lit(islands)))
        packed = _islands(dealt.select(*_columns()), islands, size, 2 * level, f"islands-{level}")
        if islands > 1:
            packed = _islands(packed.select(*_columns()), islands, size, 2 * level + 1, f"migrated-{level}").filter("kind = 0")
        if islands == 1 or level == LEVELS - 1:
            done.append((level, packed))
            break
        full = F.col("fill") >= FULL_ENOUGH * size
        done.append((level, packed.filter(full)))
        rows = packed.filter(~full).select("doc", "kind", *(v.alias(k) for k, v in none.items()), *_PIECES)
    out = None
    for level, found in done:
        ids = (F.lit(level).cast("long") * (1 << 58) + F.col("island") * (1 << _BITS) + F.col("bin")).alias("sequence_id")
        own = found.select(*_PIECES, ids)
        out = own if out is None else out.unionByName(own)
    if out is None:
        return whole
    spread = out.repartition(partitions(out.sparkSession), "sequence_id").sortWithinPartitions("sequence_id", "doc_id", "piece")
    return whole.unionByName(spread.mapInArrow(_place, f"{_PIECE_SCHEMA}, sequence_id long, offset long"))


def _columns() -> list[str]:
    return ["island", "doc", "kind", "bin", "fill", "pattern", *_PIECES]
