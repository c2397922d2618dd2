"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces. DataFrame functions only.

Sections are cut at empty lines (two line feeds), paragraphs at line feeds, paragraphs into pieces; joined again with those
separators they give the text, so roots are equal exactly where texts are. A piece ends where its content says so: after
``LEAST`` characters or more, at a punctuation mark or at white space after an e, an s or a character that isn't a Latin
letter, and after ``MOST`` characters at the latest. So an insertion changes the pieces that it touches and, until the next
common end, a few after them; the rest of the paragraph keeps its nodes.

A piece's node is its MD5, every inner node the SHA-256 of its children's nodes. A fingerprint is the root in full and the
tree's nodes shortened, in base64: 4 characters a piece, 8 a paragraph, 8 a section, some 0.15 of the text's length::

    root | section node : paragraph node - piece nodes . paragraph ... ; section ...

Two fingerprints are alike by the share of their distinct pieces that both have (Dice); equal roots are 1. ``locate``
compares branches and gives the sections and paragraphs that differ.

Defined results: a null text equals an empty one, whose fingerprint is that of one empty paragraph; equal texts have
equal fingerprints, whatever their doc_ids; in ``edit_study`` null doc_ids come first, and rows with equal doc_ids are
ordered by a hash of their texts (rows repeated outright follow one another); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwire.llm.common import cut, id_text, partitions

#: Characters of a piece, the leaf of the tree.
LEAST, MOST = 24, 96
#: A piece. The lazy first branch takes the first end that the content gives.
PIECE = rf"(?s).{{{LEAST - 1},{MOST - 1}}}?(?:\p{{Punct}}|\p{{P}}|(?<=[es\P{{IsLatin}}])\s)|.{{1,{MOST}}}"
#: Characters of a shortened node: 24 bits of a piece, 48 of a paragraph or section.
LEAF, INNER = 4, 8
#: Steps by which buckets of successive doc_ids widen, from 2 ** 10 of them on, until a bucket has FULL documents on average.
STEPS, FULL = range(10, 61, 10), 64
#: A bucket of more rows is split further, by its doc_ids and hashes of texts.
HOT = 20_000


def _short(node: Column, characters: int) -> Column:
    """The first characters of a hexadecimal node in base64."""
    return F.base64(F.unhex(F.substring(node, 1, characters * 3 // 2)))


def _tree(text: Column) -> Column:
    """array of (node, shown) of the sections."""
    pieces = F.transform(
        F.split(text, "\n\n"),
        lambda s: F.transform(F.split(s, "\n"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), 0), F.md5)),
    )
    paragraphs = F.transform(
        pieces,
        lambda s: F.transform(
            s, lambda p: F.struct(F.sha2(F.concat(F.lit("p"), F.array_join(p, "")), 256).alias("node"), F.array_join(F.transform(p, lambda x: _short(x, LEAF)), "").alias("shown"))
        ),
    )
    return F.transform(
        paragraphs,
        lambda s: F.struct(
            F.sha2(F.concat(F.lit("s"), F.array_join(F.transform(s, lambda p: p["node"]), "")), 256).alias("node"),
            F.array_join(F.transform(s, lambda p: F.concat(_short(p["node"], INNER), F.lit("-"), p["shown"])), ".").alias("shown"),
        ),
    )


def with_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` and the fingerprint of one of its text columns."""
    made = df.withColumn("_tree", _tree(F.coalesce(F.col(text_col), F.lit(""))))
    root = F.sha2(F.concat(F.lit("r"), F.array_join(F.transform("_tree", lambda s: s["node"]), "")), 256)
    shown = F.array_join(F.transform("_tree", lambda s: F.concat(_short(s["node"], INNER), F.lit(":"), s["shown"])), ";")
    return made.withColumn(out, F.concat(root, F.lit("|"), shown)).drop("_tree")


def root_of(fingerprint: Column) -> Column:
    return F.substring(fingerprint, 1, 64)


def pieces_of(fingerprint: Column) -> Column:
    """The nodes of the pieces."""
    leaves = F.regexp_replace(F.substr(fingerprint, F.lit(66)), rf"[^:.;\-]{{{INNER}}}[:\-]|[.;]", "")
    return F.regexp_extract_all(leaves, F.lit(rf".{{{LEAF}}}"), 0)


def likeness(a: Column, b: Column, a_pieces: Column, b_pieces: Column) -> Column:
    """0 to 1, of two fingerprints and their distinct pieces."""
    both = 2.0 * F.size(F.array_intersect(a_pieces, b_pieces)) / F.greatest(F.size(a_pieces) + F.size(b_pieces), F.lit(1))
    return F.when(root_of(a) == root_of(b), 1.0).otherwise(both)


def locate(df: DataFrame, a: str, b: str) -> DataFrame:
    """For each row whose fingerprints ``a`` and ``b`` differ: its columns, section and paragraph (from 0) of each paragraph that differs."""
    branches = lambda c: F.transform(F.split(F.substr(F.col(c), F.lit(66)), ";"), lambda s: F.split(F.substring_index(s, ":", -1), r"\."))
    sections = F.arrays_zip(branches(a).alias("x"), branches(b).alias("y"))
    rows = df.filter(root_of(F.col(a)) != root_of(F.col(b))).select(*df.columns, F.posexplode(sections).alias("section", "_s")).filter("not _s.x <=> _s.y")
    paragraphs = F.arrays_zip(F.coalesce("_s.x", F.array()).alias("x"), F.coalesce("_s.y", F.array()).alias("y"))
    return rows.select(*df.columns, "section", F.posexplode(paragraphs).alias("paragraph", "_p")).filter("not _p.x <=> _p.y").drop("_p")


def successors(keys: DataFrame) -> DataFrame:
    """(key, next) of a table of distinct keys; next is null for the largest.

    Keys are dealt by ranges and ordered within them; the ranges' first keys, one a partition, give the rest.
    """
    placed = keys.select("key").repartitionByRange(partitions(keys.sparkSession), "key").withColumn("range", F.spark_partition_id())
    placed = cut(placed, "ranges")
    after = F.lead("key").over(Window.partitionBy("range").orderBy("key"))
    heads = placed.groupBy("range").agg(F.min("key").alias("head"))
    heads = heads.select("range", F.lead("head").over(Window.orderBy("range")).alias("head"))  # a row for each partition
    return placed.withColumn("next", after).join(F.broadcast(heads), "range").select("key", F.coalesce("next", "head").alias("next"))


def _width(docs: DataFrame) -> int:
    """Bits of doc_id that a bucket spans: few enough for dense ids, more where ids are far apart (hashes, for instance)."""
    counts = docs.agg(F.count("doc_id"), *(F.approx_count_distinct(F.shiftright("doc_id", n)) for n in STEPS)).first()
    return next((n for n, buckets in zip(STEPS, counts[1:], strict=True) if buckets * FULL <= counts[0]), STEPS[0] if counts[0] < FULL else STEPS[-1])


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, next_text, next_fingerprint: the next document by ascending doc_id, after the last the first.

    Texts are shuffled once, by ranges of buckets of doc_ids; each bucket's last document finds its next one by a join.
    Buckets of more than ``HOT`` rows, as of null doc_ids or of one that is repeated, are split by doc_id, hash of the text
    and, for rows repeated outright, at random.
    """
    width = _width(docs)
    docs = docs.withColumn("bucket", F.coalesce(F.shiftright("doc_id", width), F.lit(-(1 << 62)))).withColumn("h", F.xxhash64("text"))
    hot = cut(docs.groupBy("bucket").count().filter(F.col("count") > HOT).select("bucket"), "hot-buckets")
    none = F.lit(None).cast("long")
    key = F.struct("bucket", none.alias("id"), none.alias("h"), none.alias("tie"))
    if not hot.isEmpty():  # at most a bucket for each HOT rows
        docs = docs.join(hot.withColumn("hot", F.lit(True)), "bucket", "left")
        key = F.when(F.col("hot"), F.struct("bucket", F.col("doc_id").alias("id"), F.shiftright("h", 52).alias("h"), F.pmod(F.monotonically_increasing_id(), F.lit(16)).alias("tie"))).otherwise(key)
        rows = cut(docs.select("doc_id", "text", "h", key.alias("bucket")), "hot-dealt")  # ties are drawn once
    else:
        rows = docs.select("doc_id", "text", "h", key.alias("bucket"))
    order = cut(successors(rows.select(F.col("bucket").alias("key")).distinct()), "bucket-order")
    first = order.agg(F.min("key").alias("first"))
    order = order.crossJoin(F.broadcast(first)).select(F.col("key").alias("bucket"), F.coalesce("next", "first").alias("next_bucket"))  # first: one row
    # under another name, so that no branch drops the alias as redundant: equal exchanges are made once
    dealt = rows.select(F.col("doc_id").alias("id"), "text", "h", "bucket").repartitionByRange(partitions(docs.sparkSession), "bucket")
    window = Window.partitionBy("bucket").orderBy(F.asc_nulls_first("id"), "h")
    onward = with_fingerprint(dealt, "text", "fingerprint")
    onward = onward.withColumn("next_text", F.lead("text").over(window)).withColumn("next_fingerprint", F.lead("fingerprint").over(window))
    inner = onward.filter("next_text is not null").drop("bucket", "h")
    # the ends of buckets: found by place, so that only their fingerprints are made again
    placed = dealt.withColumn("n", F.row_number().over(window)).withColumn("more", F.lead(F.lit(1)).over(window))
    heads = with_fingerprint(placed.filter("n = 1").select(F.col("bucket").alias("next_bucket"), F.col("text").alias("next_text")), "next_text", "next_fingerprint")
    last = with_fingerprint(placed.filter("more is null").select("id", "text", "bucket"), "text", "fingerprint")
    last = last.join(order, "bucket").join(heads, "next_bucket")
    return inner.unionByName(last.drop("bucket", "next_bucket")).withColumnRenamed("id", "doc_id")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of every row."""
    return with_fingerprint(id_text(docs, id_col, text_col), "text", "fingerprint").select("doc_id", "fingerprint")


def edit_study(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against itself with its second half overwritten by the next document's start, and against that document."""
    rows = with_next(id_text(docs, id_col, text_col)).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    rows = with_fingerprint(rows.drop("text", "next_text"), "edited", "edited_fingerprint").drop("edited")
    for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        rows = rows.withColumn(f"{c}_pieces", F.array_distinct(pieces_of(F.col(c))))
    near = lambda c: likeness(F.col("fingerprint"), F.col(c), F.col("fingerprint_pieces"), F.col(f"{c}_pieces"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("edited_fingerprint").alias("near_edited"), near("next_fingerprint").alias("near_next"))
