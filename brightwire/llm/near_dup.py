"""MinHash near-dedup by a multi-index Hamming join, every link confirmed on full shingle sets.

1. A document's set is its distinct shingles of five words, as 64-bit hashes. Documents with equal sets form a class,
   which goes on as one node under its smallest doc_id.
2. ``SYMBOLS`` minhashes of 32 bits make a signature. The join finds signatures that differ in at most ``DISTANCE`` symbols.
   Two documents at a similarity of 0.75 differ in more with a chance of 1.4e-6; this is all that may be missed.
3. The symbols are split into ``CHUNKS`` chunks; of each chunk every way to leave one symbol out is a key. Were at most one
   chunk of a pair to differ in fewer than two symbols, the pair would differ in ``2 * (CHUNKS - 1)`` symbols or more, which
   is beyond ``DISTANCE``: so all pairs within the distance share keys of at least two chunks.
4. Within each bucket of a key, signatures (compared by 16 bits a symbol, which never adds to a distance) within the
   distance are joined, a spanning forest at most: no pairs of a group are written. Buckets with equal members are done
   once. The forests' connected components are cells; a link never leaves its cell.
5. Each cell's full sets are compared exactly. The confirmed links' connected components are the result.

A bucket of up to ``BUCKET`` documents, and a cell of up to ``BLOCK`` documents and ``SHINGLES`` shingles, is compared
whole. A larger one is first compared block by block, every block beside the same ``PIVOTS`` documents, which joins most of
a large group of near copies in linear work. Where documents stay outside the largest component (a passage or a template
that many unlike documents share), prefix filtering on full sets finds the documents that may still be linked
(``_prefix_pairs``): those of a bucket are then joined by their signatures, those of a cell by their sets. So nothing large
is compared block against block but documents that share their rare shingles.

Defined results: null and empty texts and texts without words have an empty set and are linked with nothing; a document
with fewer than five words has one shingle, all its words; rows with a null doc_id are linked with nothing (component
null, kept); rows with equal doc_ids are one document, linked with what any of its texts is linked with, each row with the
size of its own text's set, and each is kept where that doc_id is; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightwire.llm.common import Bounded, cut, id_text, partitions, sorted_groups, tidied
from brightwire.llm.components import connected_components

WORDS = 5
SYMBOLS, CHUNKS = 64, 18
#: Most symbols in which two signatures of the join may differ.
DISTANCE = 2 * (CHUNKS - 1) - 1
#: The chunk of each symbol; chunks have three or four.
CHUNK_OF = np.arange(SYMBOLS) * CHUNKS // SYMBOLS
BUCKET, BLOCK, SHINGLES, PIVOTS = 4096, 512, 1_500_000, 32
#: Tables of up to this number of rows (40 bytes each at most) are broadcast, so that the large side isn't shuffled; larger
#: ones are joined by a shuffle, whose hot partitions adaptive execution can split, since both sides are read from tables.
BROADCAST_ROWS = 1_000_000

_rng = np.random.default_rng(20240201)
_ODD = _rng.integers(1, 1 << 63, SYMBOLS, np.uint64) << np.uint64(1) | np.uint64(1)
_XOR = _rng.integers(0, 1 << 63, SYMBOLS, np.uint64)
_STEP = _rng.integers(1, 1 << 63, WORDS, np.uint64) << np.uint64(1) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KEY = _rng.integers(1, 1 << 63, (2, SYMBOLS), np.uint64) << np.uint64(1) | np.uint64(1)


def normal_words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space (which is what bytes.lower and bytes.split do)."""
    return text.lower().split()


def word_hashes() -> Bounded:
    import xxhash

    return Bounded(xxhash.xxh3_64_intdigest, 150_000)


def shingles(words: list[bytes], hashes: Bounded) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a document's shingles."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    out = h[:n] * _STEP[0]
    for k in range(1, WORDS):
        out ^= out >> np.uint64(31)
        out += h[k : k + n] * _STEP[k]
    out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(own: np.ndarray) -> np.ndarray:
    """``SYMBOLS`` minhashes of 32 bits, mixed so that all their bits differ where the minima do."""
    best = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(own), 4096):
        best = np.minimum(best, ((own[s : s + 4096, None] ^ _XOR) * _ODD).min(0))
    best ^= best >> np.uint64(33)
    best *= _MIX
    return (best >> np.uint64(32)).astype(np.uint32)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature and each symbol a key of the other symbols of its chunk."""
    parts = signatures.astype(np.uint64) * _KEY[0]
    whole = np.add.reduceat(parts, np.searchsorted(CHUNK_OF, np.arange(CHUNKS)), axis=1)
    key = whole[:, CHUNK_OF] - parts + _KEY[1]
    key ^= key >> np.uint64(31)
    key *= _MIX
    return key ^ key >> np.uint64(29)


_PREPARED = "doc_id long, row long, n_shingles long, d1 long, d2 long, sig binary, keys array<long>, payload binary"


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, row, text) to sets' digests, signatures, keys, and the words for the exact comparison."""
    import xxhash
    import zstandard

    hashes, pack = word_hashes(), zstandard.ZstdCompressor(level=1).compress
    names = ["doc_id", "row", "n_shingles", "d1", "d2", "sig", "keys", "payload"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())

    def made(out: list[tuple], signs: list[np.ndarray]) -> pa.RecordBatch:
        cols = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        many = np.cumsum([0, *(SYMBOLS * (row[2] > 0) for row in out)]).astype(np.int32)
        flat = chunk_keys(np.stack(signs)).view(np.int64).ravel() if signs else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([*cols[:6], pa.ListArray.from_arrays(pa.array(many), pa.array(flat)), cols[6]], names)

    for batch in batches:
        out, signs = [], []
        for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            words = normal_words(text.as_buffer().to_pybytes())
            own = shingles(words, hashes)
            if len(own):
                signs.append(signature(own))
                d = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64).tolist()
                out.append((doc, row, len(own), *d, signs[-1].astype(np.uint16).tobytes(), pack(b" ".join(words))))
            else:
                out.append((doc, row, 0, None, None, None, None))
            if len(out) == 2000:
                yield made(out, signs)
                out, signs = [], []
        if out:
            yield made(out, signs)


class Union:
    """Disjoint sets of 0 to n - 1; the smallest member stands for its set."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _stars(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    """Links (u, v, tag) contracted: every document with the smallest one that they join it with."""
    place: dict[int, int] = {}
    tags: dict[int, int] = {}
    for u, v, tag in found:
        for x in (u, v):
            place.setdefault(x, 0)
            tags[x] = tag
    docs = sorted(place)
    place.update((x, i) for i, x in enumerate(docs))
    sets = Union(len(docs))
    for u, v, _ in found:
        sets.join(place[u], place[v])
    stars = [(x, docs[r], tags[x]) for i, x in enumerate(docs) if (r := sets.find(i)) != i]
    u, v, t = zip(*stars, strict=True) if stars else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(t, pa.int64())], ["u", "v", "tag"])


def _edges_of(per_group: Callable[[pa.Table], list[tuple[int, int]]], keys: int):
    """A group's links get its ``tag`` column's value, 0 without one; no group's links are split over two batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        for group in sorted_groups(batches, keys):
            tag = group.column("tag")[0].as_py() if "tag" in group.column_names else 0
            out.extend((u, v, tag) for u, v in per_group(group))
            if len(out) >= 200_000:
                yield _stars(out)
                out = []
        yield _stars(out)

    return run


def _merge(labels: np.ndarray, i: int, near: np.ndarray) -> list[int]:
    """Of the places ``near`` one of each set that isn't i's, whose sets then become one with it. ``labels``: the set of each place."""
    out = []
    for label in np.unique(labels[near]).tolist():
        if label != labels[i]:
            out.append(int(near[np.argmax(labels[near] == label)]))
            labels[labels == label] = labels[i]
    return out


def _signature_forest(group: pa.Table) -> list[tuple[int, int]]:
    """A spanning forest of the documents of a bucket whose signatures are near."""
    doc, n = group.column("doc").to_pylist(), group.column("n_shingles").to_numpy()
    m = len(doc)
    if m < 2:
        return []
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint16).reshape(m, SYMBOLS)
    labels, out = np.unique(group.column("component" if "component" in group.column_names else "doc").to_numpy(), return_inverse=True)[1], []
    for i in range(m - 1):
        if (labels == labels[0]).all():
            break
        others = np.flatnonzero(labels[i + 1 :] != labels[i]) + i + 1
        near = (sig[others] != sig[i]).sum(1) <= DISTANCE
        near &= 4 * np.minimum(n[others], n[i]) >= 3 * np.maximum(n[others], n[i])
        out.extend((doc[i], doc[j]) for j in _merge(labels, i, others[near]))
    return out


def exact_forest(sets: list[np.ndarray], own: list[int]) -> list[tuple[int, int]]:
    """Links (places i, j) that span all links of the documents: 100 * intersection >= 75 * union. ``own``: known components."""
    m = len(sets)
    labels = np.unique(np.array(own), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    every, at = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(m), sizes)
    order = np.argsort(at, kind="stable")
    holders, begin = doc[order], np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(every)))))
    ends = np.cumsum(sizes)
    out = []
    for i in range(m - 1):
        if (labels == labels[0]).all():
            break
        own_at = at[ends[i] - sizes[i] : ends[i]]
        counts = begin[own_at + 1] - begin[own_at]
        take = np.repeat(begin[own_at] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        both = np.bincount(holders[take], minlength=m)[i + 1 :]
        linked = 100 * both >= 75 * (sizes[i] + sizes[i + 1 :] - both)
        out.extend((i, j) for j in _merge(labels, i, np.flatnonzero(linked & (labels[i + 1 :] != labels[i])) + i + 1))
    return out


def _confirmed(group: pa.Table) -> list[tuple[int, int]]:
    import zstandard

    if group.num_rows < 2:
        return []
    hashes, expand = word_hashes(), zstandard.ZstdDecompressor().decompress
    docs = group.column("doc").to_pylist()
    sets = [shingles(expand(p.as_buffer().to_pybytes()).split(), hashes) for p in group.column("payload")]
    own = group.column("component").to_pylist() if "component" in group.column_names else docs
    return [(docs[i], docs[j]) for i, j in exact_forest(sets, own) if docs[i] != docs[j]]


def _by_group(rows: DataFrame, keys: list[str], work: Callable[[pa.Table], list[tuple[int, int]]]) -> DataFrame:
    dealt = rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "doc")
    return dealt.mapInArrow(tidied(_edges_of(work, len(keys))), "u long, v long, tag long")


def _small(rows: DataFrame) -> DataFrame:
    """``rows``, marked for a broadcast where its checked size allows it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _with_roots(found: DataFrame) -> DataFrame:
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def _placed(rows: DataFrame, blocks) -> DataFrame:
    """Rows (group, doc, ...) with ``blocks``, the number of their group's blocks, and the block that a hash deals them to."""
    return rows.withColumn("blocks", F.greatest(blocks, F.lit(1)).cast("int")).withColumn("block", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))


def _linked(
    rows: DataFrame, data: list[str], work: Callable[[pa.Table], list[tuple[int, int]]],
    pairs: Callable[[DataFrame, list[str]], DataFrame],
) -> tuple[DataFrame, DataFrame | None]:
    """Stars (u, v, tag) that join all documents of each group which ``work`` links.

    A group of one block is done at once (tag 1). Of larger ones every block is done beside the group's pivots; then the
    groups in which some documents are ``out``side the largest component go through ``pairs``, which gives the pairs of
    blocks (a, b) that are left to do. The second table is that pass's stars, None where no group is large.
    """
    plain = ["group", "block", "doc", *data]
    large = cut(rows.filter("blocks > 1"), "large-groups")
    any_large = not large.isEmpty()
    once = rows.select(*plain, "blocks")
    if any_large:
        once = once.unionByName(_pivots(large, data).select(*plain, "blocks"))
    first = cut(_by_group(once.withColumn("tag", F.col("blocks").cast("long")).drop("blocks"), ["group", "block"], work), "links")
    if not any_large:
        return first, None
    found = _small(cut(_with_roots(connected_components(first.select("u", "v"))), "large-found"))
    rest = large.drop("component").join(found, large.doc == found.node, "left").withColumn("component", F.coalesce("component", "doc")).drop("node")
    rest = cut(rest, "large-rest")
    counts = rest.groupBy("group", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("group").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts")).filter("parts > 1").drop("parts")
    main = _small(cut(main, "large-main"))
    rest = rest.join(main, "group").withColumn("out", F.col("component") != F.col("main")).drop("main")
    return first, cut(_by_group(pairs(rest, data), ["group", "a", "b"], work), "late-links")


def _pivots(large: DataFrame, data: list[str]) -> DataFrame:
    """The pivots of each group beside its other blocks: from each block the documents with the lowest hashes, ``PIVOTS`` a group or one a block."""
    each, order = F.greatest(F.lit(1), F.ceil(F.lit(PIVOTS) / F.col("blocks"))), Window.partitionBy("group", "block").orderBy(F.xxhash64("doc", F.lit(1)), "doc")
    near = large.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= each)
    others = near.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other != block")
    return others.select("group", F.col("other").alias("block"), "blocks", "doc", *data)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, doc, payload) to a row for each shingle, with the size of the document's set."""
    import zstandard

    hashes, expand = word_hashes(), zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            sets = [shingles(expand(p.as_buffer().to_pybytes()).split(), hashes) for p in part.column(2)]
            sizes = np.array([len(s) for s in sets])
            take = pa.array(np.repeat(np.arange(len(sets)), sizes), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(take), part.column(1).take(take), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(sets).view(np.int64))], ["group", "doc", "size", "shingle"]
            )


def _prefix_pairs(rest: DataFrame, data: list[str]) -> DataFrame:
    """The pairs of blocks left to do in large groups, by prefix filtering on full sets (``payload``).

    A document's shingles are ordered by how many documents of the group have them. Two linked sets, y not larger than x, have
    one in common that is among the first ``|x| - ceil(3/4 |x|) + 1`` of x (x is asked by it) and the first ``|y| - ceil(6/7 |y|) + 1`` of y
    (y is listed by it). So only documents with such a shingle meet, and of those only pairs with one document outside the
    group's largest component and one listed. Shingles of a single document come first and meet nothing: documents that
    share a template, and are too unlike for a link, have their own words there, and meet nobody.
    """
    own = rest.groupBy("group", "doc").agg(F.first("component").alias("component"), F.max("out").alias("out"))
    found = cut(rest.select("group", "doc", "payload").mapInArrow(tidied(_shingled), "group long, doc long, size long, shingle long"), "rest-shingles")
    counts = _small(cut(found.groupBy("group", "shingle").agg(F.count("*").alias("n")).filter("n > 1"), "rest-counts"))
    shared = found.join(counts, ["group", "shingle"]).groupBy("group", "doc", "size").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("shared"))
    alone, size = F.col("size") - F.size("shared"), F.col("size")
    asked, listed = size - F.expr("(3 * size + 3) div 4") + 1 - alone, size - F.expr("(6 * size + 6) div 7") + 1 - alone
    entries = shared.filter(asked > 0).select("group", "doc", F.posexplode(F.slice("shared", F.lit(1), asked.cast("int"))).alias("at", "s"), listed.alias("listed"))
    entries = entries.select(F.xxhash64("group", "s.shingle").alias("key"), "group", "doc", (F.col("at") < F.col("listed")).alias("listed"))
    entries = cut(entries.join(own, ["group", "doc"]).select("key", "doc", "component", "out", "listed"), "prefixes")
    many = lambda c: F.count_if(c)
    out, listed = F.col("out"), F.col("listed")
    groups = entries.groupBy("key").agg(
        F.count("*").alias("n"), many(listed).alias("n_listed"), many(out & listed).alias("n_out_listed"), many(out & ~listed).alias("n_out_asked"),
        F.bit_xor(F.xxhash64("doc", "listed")).alias("members"), (F.min("component") != F.max("component")).alias("open"),
    )
    groups = groups.filter("open and n_listed > 0 and n_out_listed + n_out_asked > 0").groupBy("n", "members").agg(F.min_by(F.struct("key", "n_listed", "n_out_listed", "n_out_asked"), "key").alias("g"))
    groups = _small(cut(groups.select("g.*", "n"), "prefix-groups"))
    members = entries.join(groups, "key")
    blocks = lambda n: F.greatest(F.ceil(F.col(n) / BLOCK), F.lit(1)).cast("int")

    def beside(case: int, left, n_left: str, right, n_right: str) -> DataFrame:
        """Each block of ``left`` beside each block of ``right``."""
        own = members.filter((F.col("n") > BLOCK) & (F.col(n_left) > 0) & (F.col(n_right) > 0))
        place = lambda n: F.pmod(F.xxhash64("doc", F.lit(case)), blocks(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
        sides = (own.filter(left).withColumn("a", place(n_left)).withColumn("b", every(n_right)), own.filter(right).withColumn("b", place(n_right)).withColumn("a", every(n_left)))
        return sides[0].select("key", "a", "b", "doc", "component").unionByName(sides[1].select("key", "a", "b", "doc", "component")).withColumn("case", F.lit(case))

    whole = members.filter(F.col("n") <= BLOCK).select("key", F.lit(0).alias("a"), F.lit(0).alias("b"), "doc", "component", F.lit(0).alias("case"))
    dealt = whole.unionByName(beside(1, out & listed, "n_out_listed", F.lit(True), "n")).unionByName(beside(2, out & ~listed, "n_out_asked", listed, "n_listed"))
    dealt = dealt.select(F.xxhash64("key", "case").alias("group"), "a", "b", "doc", "component")
    return dealt.join(rest.select("doc", *data), "doc").select("group", "a", "b", "doc", *data, "component")


def _once(keyed: DataFrame) -> DataFrame:
    """(group, n) of the buckets (row, group) with several members; of buckets with equal members one stays."""
    buckets = keyed.groupBy("group").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("rows")).filter("n > 1")
    return _small(cut(buckets.groupBy("n", "rows").agg(F.min("group").alias("group")).select("group", "n"), "buckets"))


def cells(nodes: DataFrame) -> DataFrame:
    """(doc, cell) of the nodes (doc, row, n_shingles, sig, keys, payload) that may have links: components of near signatures."""
    keyed = nodes.select("doc", "row", F.explode("keys").alias("group"))
    members = cut(keyed.join(_once(keyed), "group").select("group", "doc", "row", "n"), "bucket-members")
    near = nodes.join(_small(cut(members.select("row").distinct(), "bucket-rows")), "row", "left_semi")
    near = cut(near.select("row", "n_shingles", "sig"), "bucket-nodes")

    def left(rest: DataFrame, data: list[str]) -> DataFrame:
        """Documents of all buckets left open as one group: each is in many buckets, and is looked at once."""
        same = [F.first(c).alias(c) for c in ("doc", "component", "n_shingles", "sig")]
        own = cut(rest.groupBy("row").agg(*same, F.max("out").alias("out")), "open-nodes")
        sets = nodes.select("row", "payload").join(_small(own), "row").withColumn("group", F.lit(0).cast("long"))
        return _prefix_pairs(cut(sets, "open-sets"), data)

    rows = _placed(members, F.ceil(F.col("n") / BUCKET)).drop("n").join(near, "row")
    first, late = _linked(rows, ["row", "n_shingles", "sig"], _signature_forest, left)
    forest = first if late is None else first.unionByName(late)
    return _with_roots(connected_components(forest)).select(F.col("node").alias("doc"), F.col("component").alias("cell"))


def links(nodes: DataFrame) -> DataFrame:
    """(node, component) of the nodes (doc, row, n_shingles, sig, keys, payload) that have links, without components' smallest."""
    rows = nodes.select("doc", "n_shingles", "payload").join(_small(cut(cells(nodes), "cells")), "doc").withColumnRenamed("cell", "group")
    rows = cut(rows, "cell-payloads")
    sizes = rows.groupBy("group").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("s"))
    rows = _placed(rows.join(_small(cut(sizes, "cell-sizes")), "group"), F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("s") / SHINGLES))).drop("m", "s")
    first, late = _linked(rows, ["payload"], _confirmed, _prefix_pairs)
    # a cell that was one group is settled: its stars lead to its components' smallest documents
    settled = first.filter("tag = 1").select(F.col("u").alias("node"), F.col("v").alias("component"))
    if late is None:
        return settled
    return settled.unionByName(connected_components(first.filter("tag > 1").unionByName(late)))


def near_dup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id it is linked with, directly or not), kept of every row."""
    rows = id_text(docs, id_col, text_col).select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    prepared = cut(rows.mapInArrow(tidied(_prepare), _PREPARED), "shingled")
    usable = prepared.filter("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    classes = _small(cut(classes.select("d1", "d2", F.col("first.doc_id").alias("doc"), F.col("first.row").alias("first")), "classes"))
    # one row of a class goes on, however often its document is repeated
    nodes = usable.join(classes, ["d1", "d2"], "left").filter("first is null or first = row").select(F.col("doc_id").alias("doc"), "row", "n_shingles", "sig", "keys", "payload")
    found = links(nodes)
    rows = prepared.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"], "left").withColumn("doc", F.coalesce("doc", "doc_id"))
    found = _with_own(rows.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "doc"), found)
    rows = rows.join(_small(cut(found, "found")).withColumnRenamed("node", "doc"), "doc", "left")
    out = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc")).alias("component_id")
    return rows.select("doc_id", "n_shingles", out).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _with_own(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (node, component), with the nodes of each document that has several texts joined. ``rows``: doc_id and its node."""
    several = cut(rows.groupBy("doc_id").agg(F.min("doc").alias("v"), F.max("doc").alias("last")).filter("v <> last").drop("last"), "several-texts")
    if several.isEmpty():
        return found
    own = rows.join(_small(several), "doc_id").select(F.col("doc").alias("u"), "v").filter("u <> v").distinct()
    return connected_components(own.unionByName(found.select(F.col("node").alias("u"), F.col("component").alias("v"))))


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with all their columns."""
    leave = _small(cut(near_dup(docs, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("_leave")).distinct(), "near-copies"))
    return docs.join(leave, F.col(id_col).cast("long") == F.col("_leave"), "left_anti")
