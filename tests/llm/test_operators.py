"""Each operator against a brute-force version, on inputs with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import base64
import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightwire.llm import byte_bpe, common, components, conversation_repair, exact_dedup, lexical_search, license_scan, line_dedup, merkle, near_dup, oracles, packing, queries, token_count, token_files, toxicity, url_filter, word_ids
from brightwire.llm.common import scratch_path

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, bitmap string, rid string, component string, bucket long, row string, k_id long"


def docs(spark, *rows):
    """Documents with further columns whose names operators use themselves."""
    return spark.createDataFrame([(d, t, "x", "x", "x", 7, "x", 1) for d, t in rows], SCHEMA)


def sample(seed=3, n=60):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "Δελτα", "été", "don't", "x1", "The", "the,", "日本"]
    text = lambda k: "\n".join(" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(k))
    base = [text(rng.randint(1, 6)) for _ in range(n)]
    rows = [(10 * i + 3, t) for i, t in enumerate(base)]
    rows += [(5, None), (6, ""), (7, base[0]), (8, base[0]), (9, " \t\n"), (9000, "long " * 30_000), (9001, base[1] + "."), (-4, "z"), (2**40, base[2])]
    return rows


def texts(rows):
    return [(d, t or "") for d, t in rows]


def sha(t):
    return hashlib.sha256(t.encode() if isinstance(t, str) else t).hexdigest()


def test_line_dedup_all(spark):
    rows = sample() + [(500 + k, f"only {k}\n  COMMON Line \t\n\n") for k in range(11)] + [(600 + k, "rare\nrare") for k in range(9)]
    key = lambda line: line.strip(WHITE).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    held = Counter(k for _, t in texts(rows) for k in {key(x) for x in t.split("\n")} if k)
    want = {}
    for d, t in texts(rows):
        lines = t.split("\n")
        kept = [x for x in lines if held[key(x)] < 10]
        want[d] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    df = docs(spark, *rows)
    got = {r.doc_id: (r.n_lines, r.n_dropped, sha(r.kept_text)) for r in line_dedup.apply_bitmaps(df, line_dedup.line_dedup(df, 10)).collect()}
    assert got == want and want[500][1] == 1


def test_line_dedup_first(spark):
    rows = sample(n=40)
    seen, want = set(), {}
    for d, t in sorted(texts(rows)):
        lines, kept = t.split("\n"), []
        for line in lines:
            k = line.strip(WHITE).encode().lower()
            if not k or k not in seen:
                kept.append(line)
            seen.add(k)
        want[d] = "\n".join(kept)
    df = docs(spark, *rows)
    got = {r.doc_id: r.kept_text for r in line_dedup.apply_bitmaps(df, line_dedup.line_dedup(df, mode="first")).collect()}
    assert got == want


def test_line_dedup_hot_line_over_partitions(spark):
    """One line in every document: its run covers all range partitions, and edges settle it."""
    df = docs(spark, *[(k, f"hot\nown {k}") for k in range(400)])
    got = line_dedup.line_dedup(df, 10)
    assert {r.n_dropped for r in got.collect()} == {1}
    assert {r.n_dropped for r in line_dedup.line_dedup(df, 401).collect()} == {0}
    assert {r.n_dropped for r in line_dedup.line_dedup(df, 400).collect()} == {1}


def test_line_dedup_repeated_and_null_ids(spark):
    df = docs(spark, *[(1, "same\na")] * 6, *[(None, "same\nb")] * 5)
    got = line_dedup.apply_bitmaps(df, line_dedup.line_dedup(df, 11)).collect()
    assert len(got) == 11 and {r.n_dropped for r in got} == {1} and {r.kept_text for r in got} == {"a", "b"}


def test_line_dedup_by_shuffled_bitmaps(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    test_line_dedup_all(spark)


def test_line_dedup_sql_counts_rows_too(spark):
    """Rows with one doc_id, and rows without one, are documents each, here and in the SQL."""
    import duckdb
    import pandas as pd

    rows = [(1, "same\na")] * 4 + [(None, "same\nb\nthird")] * 3 + [(k, f"same\nTHIRD \n{k}") for k in range(2, 5)] + [(9, None)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([d for d, _ in rows], "Int64"), "text": [t for _, t in rows]}))
    want = Counter(con.execute(oracles.oracle_sql()["op1_line_dedup"]).fetchall())
    df = docs(spark, *rows)
    got = line_dedup.apply_bitmaps(df, line_dedup.line_dedup(df, 10)).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, sha(r.kept_text)) for r in got) == want and len(got) == len(rows)
    assert {r.n_dropped for r in got if r.doc_id == 1} == {1} and {r.n_dropped for r in got if r.doc_id == 2} == {1}


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))


@pytest.mark.parametrize("planes", [4, 32])
def test_token_files(spark, word_tokenizer, planes):
    rows, start, want = sample(), 0, {}
    for d, t in sorted(texts(rows)):
        ids = [*word_tokenizer.encode(t, add_special_tokens=False).ids, 1]
        want[d] = (start, ids)
        start += len(ids)
    target = scratch_path(spark, "test-files")
    token_files.write_token_files(docs(spark, *rows), queries.vocabulary("word_bpe_49k.json"), target, block=1000, planes=planes)
    got = {r.doc_id: (r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_token_files(spark, target).collect()}
    assert got == want
    sums = {r.doc_id: r.ids_crc32 for r in token_files.read_digests(spark, target).collect()}
    assert sums == {d: zlib.crc32(np.array(i, "<u4").tobytes()) for d, (_, i) in want.items()}


def test_token_files_roll_over(spark, word_tokenizer, monkeypatch):
    """Files of few blocks: documents go on in the next one; null and repeated doc_ids have their places."""
    monkeypatch.setattr(token_files, "FILE_BLOCKS", 3)
    monkeypatch.setattr(token_files, "FILE_DOCS", 12)
    rows = [*sample(n=30), (None, "no id at all"), (None, None), (3, "again the same id"), *[(13, "one row over and over")] * 40]
    encoded = {t: [*word_tokenizer.encode(t, add_special_tokens=False).ids, 1] for _, t in texts(rows)}
    want = Counter((d, len(encoded[t]), zlib.crc32(np.array(encoded[t], "<u4").tobytes())) for d, t in texts(rows))
    target = scratch_path(spark, "test-rolls")
    token_files.write_token_files(docs(spark, *rows), queries.vocabulary("word_bpe_49k.json"), target, block=64)
    got = token_files.read_digests(spark, target).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [-(2**63) if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    whole = token_files.read_token_files(spark, target).collect()
    assert Counter((r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in whole) == want
    files = [bytes(r.content) for r in token_files._files(spark, target).collect()]
    assert all(token_files.TokenFile(io.BytesIO(f)).index.size <= 3 for f in files if f) and len(files) > 20


def test_ranges_of_a_file():
    writer, rng = token_files.FileWriter(block=10, planes=4, file_blocks=100), np.random.default_rng(5)
    ids = rng.integers(0, 50_000, 333).astype("<u4")
    frames = [*writer.add(1, ids[:40].tobytes()), *writer.add(None, b""), *writer.add(3, ids[40:].tobytes()), *writer.close()]
    file = token_files.TokenFile(io.BytesIO(b"".join(f + b"\n" for f in frames)))
    assert file.docs == [(1, False, 40, 0), (None, False, 0, 0), (3, False, 293, 0)]
    opened = []
    file.block = lambda k, own=file.block: (opened.append(k), own(k))[1]
    for first, n in ((0, 333), (0, 1), (95, 10), (100, 10), (332, 1), (5, 0)):
        opened.clear()
        assert file.ids(first, n).tolist() == ids[first : first + n].tolist()
        assert opened == (list(range(first // 10, -(-(first + n) // 10))) if n else [])


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000, 4099):
        ids = rng.integers(0, 1 << 32, n, np.uint64).astype("<u4")
        for planes in (4, 32):
            assert (token_files.unpack_block(token_files.pack_block(ids, planes), n, planes) == ids).all()


RULES = [("block", "com"), ("allow", "Example.com/en/7"), ("block", "example.com/en/7"), ("allow", "a.b.org"), ("block", "b.org/x/"), ("allow", "net/de/"), ("block", "net/de/8")]
URLS = [
    "https://a.example.COM/en/712?q", "http://example.com/en/6", "http://x.a.b.org/x/1", "http://b.org/x/", "http://b.org/x", "http://notnet/de/1", "http://h.net/de/85/9", "http://h.net/de/7#/x",
    "no scheme", "", None, "http://", "http://u@h.net:80/de/", "http://?x", "a://b.org/x/y://z",
]


def brute_url(url, rules):
    at = (url or "").find("://")
    rest = "" if at < 0 else url[at + 3 :]
    cut = lambda s, stop: s[: min([s.index(c) for c in stop if c in s], default=len(s))]
    host = cut(rest, "/?#")
    path = cut(rest[len(host) :], "?#")
    host = host.encode().lower().decode()
    fits = [(h.count("."), len(p), v == "block", v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[4], best[3] if best else "allow"


@pytest.mark.parametrize("limit", [4_000_000, 0])
def test_url_filter(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "MAX_TRIE_BYTES", limit)
    rules = [url_filter.parse_rule(*r) for r in RULES]
    df = spark.createDataFrame([(n, u, "x", "y") for n, u in enumerate(URLS)], "page_id long, url string, host string, row string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df, rules).collect()}
    assert got == {n: brute_url(u, rules) for n, u in enumerate(URLS)}


def test_url_filter_repeated_rows_and_long_urls(spark):
    """Rows that repeat, null page_ids, and a segment of a million characters, which is looked up once a rule's length."""
    long = "http://h.net/de/8" + "x" * 1_000_000
    rows = [(1, URLS[0])] * 30 + [(None, long)] * 2 + [(None, None)] * 2 + [(7, "http://" + "a." * 100_000 + "example.com/en/7")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = [url_filter.parse_rule(*r) for r in RULES]
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df, rules).collect())
    assert got == Counter((n, *brute_url(u, rules)) for n, u in rows)


def test_url_filter_by_the_rules_of_its_contract(spark, tmp_path):
    """The verdicts by hand, of the query's own rules: .net's German pages are allowed, example.net's eighth ones blocked."""
    want = {
        "http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/7": ("example.com/en/7", "allow"), "http://example.com/en/6": ("com/en/", "block"),
        "http://a.net/de/8": ("net/de/", "allow"), "http://x.example.net/de/85": ("example.net/de/8", "block"), "http://example.net/de/7": ("net/de/", "allow"),
        "http://a.org/es/1": ("org/es/", "block"), "http://a.org/en/1": (None, "allow"),
    }
    spark.createDataFrame(list(enumerate(want)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.rule, r.verdict) for r in queries.op3_url_filter(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(want.values()))


def test_rule_syntax():
    with pytest.raises(ValueError):
        url_filter.parse_rule("deny", "a.com")
    with pytest.raises(ValueError):
        url_filter.parse_rule("allow", "/path")


ODD = ["", " ", "  a  b ", "don't we'll 're '", "<|endoftext|>x<|endoftext|>", "a\u0301\u00a0\u2003b\x1cc\x85", "x" * 3000, "\n\n  x\r\n\ty", "İstanbul ΣΑΣ ß", "🙂🙂 ok", "1234 5a6", "''s's"]


def test_token_count(spark):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = sample() + [(700 + n, t) for n, t in enumerate(ODD)]
    want = {d: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for d, t in texts(rows)}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_count.count_tokens(docs(spark, *rows), path).collect()} == want


@pytest.mark.parametrize("letters", ["abcdefghij", "the", "7", "!?-", " \n"])
def test_token_count_of_a_word_beyond_a_mebibyte(letters):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    text = "".join(random.Random(3).choices(letters, k=(1 << 20) + 5_000))
    assert token_count.MergeCounter(path).count(text) == len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def random_text(rng, n):
    return "".join(rng.choices(list("ab 's'tr'reve'll \n\t  12.,!?é日本\x1c\x85\xa0İΣßＡ\u0301\r\x0b\x00"), k=n))


def test_byte_bpe(spark):
    import public_tokenizers
    import tiktoken

    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    rows = sample() + [(700 + n, t) for n, t in enumerate([*ODD, *(random_text(rng, rng.randint(0, 200)) for _ in range(200))])]
    df = docs(spark, *rows)
    got = {r.doc_id: r for r in byte_bpe.encode_texts(df, path).collect()}
    for d, t in texts(rows):
        assert got[d].ids == library.encode_ordinary(t)
        pieces = [t[a:b] for a, b in zip(got[d].offsets, [*got[d].offsets[1:], len(t)], strict=False)]
        assert "".join(pieces) == t and sum(got[d].piece_ids) == len(got[d].ids)
        at = 0
        for piece, n in zip(pieces, got[d].piece_ids, strict=True):
            assert library.decode_bytes(got[d].ids[at : at + n]) == piece.encode()
            at += n
    back = {r.doc_id: bytes(r.data) for r in byte_bpe.decode_ids(byte_bpe.encode_texts(df, path), path).collect()}
    assert back == {d: t.encode() for d, t in texts(rows)}
    sums = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.round_trip(df, path).collect()}
    assert sums == {d: (len(i), sha(" ".join(map(str, i))), sha(t)) for d, t in texts(rows) for i in [library.encode_ordinary(t)]}


def test_byte_bpe_segments_null_and_repeated_ids(spark, monkeypatch):
    """Long texts are scanned in segments, cut where no token reaches over."""
    import public_tokenizers
    import tiktoken

    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(byte_bpe, "SEGMENT", 40)
    rng = random.Random(6)
    coder = byte_bpe.coder(path)
    for _ in range(300):
        text = random_text(rng, rng.randint(0, 400))
        assert "".join(byte_bpe.segments(text)) == text
        ((ids, offsets, counts),) = coder.encode([text])
        assert ids.tolist() == library.encode_ordinary(text) and counts.sum() == len(ids)
        assert offsets.tolist() == sorted(set(offsets.tolist())) and (not text or offsets[0] == 0)
    rows = [(None, "no id"), (None, "no id"), (None, None), (4, "twice"), (4, "twice"), (4, "another text")]
    got = Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in byte_bpe.round_trip(docs(spark, *rows), path).collect())
    assert got == Counter((d, len(library.encode_ordinary(t)), sha(t)) for d, t in texts(rows))


def test_caches_are_bounded():
    cache = common.Bounded(len, cap=3, longest=5)
    assert [cache[k] for k in ("a", "bb", "toolong", "bb", "ccc", "dddd")] == [1, 2, 7, 2, 3, 4] and set(cache) == {"a", "bb", "ccc"}
    encoder = word_ids.WordEncoder(queries.vocabulary("word_bpe_49k.json"), pieces=50, words=50)
    for k in range(4):
        encoder.encode([b" ".join(b"w%d" % (100 * k + i) + b"x" * i for i in range(90))])
        assert len(encoder.known) <= 100 and all(len(p) <= word_ids.LONGEST for p in encoder.known)


def test_scan_equals_one_step_at_a_time():
    rng = np.random.default_rng(2)
    for n in (1, 63, 64, 65, 1000, 64 * 40):
        inputs = rng.integers(0, 9, n).astype(np.uint8)
        state, want = 0, []
        for x in inputs.tolist():
            want.append(int(byte_bpe.BEGINS[x * 8 + state]))
            state = int(byte_bpe.STEP[x * 8 + state])
        assert byte_bpe.scan(inputs).tolist() == want


def near_brute(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(d, set()).update({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else ())
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def families(seed=9, groups=12, size=9):
    rng = random.Random(seed)
    rows, word = [], lambda: "w%d" % rng.randint(0, 5000)
    for g in range(groups):
        base = [word() for _ in range(rng.choice((3, 5, 6, 30, 120)))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows) * 3 + g % 2, " ".join(own)))
    return rows


def test_near_dup(spark):
    rows = families() + [(9001, None), (9002, ""), (9003, " \n "), (9004, "One two"), (9005, "one\tTWO"), (9006, "two one"), (9007, "long " * 20_000 + "end of it"), (9008, "long " * 20_000 + "end of it")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_dup(docs(spark, *rows)).collect()}
    assert got == {d: (n, c, d == c) for d, (n, c) in near_brute(rows).items()}
    assert sorted(r.doc_id for r in near_dup.keep_rows(docs(spark, *rows)).collect()) == sorted(d for d, (_, c, _) in got.items() if d == c)


def test_near_dup_by_blocks_and_shuffles(spark, monkeypatch):
    """Buckets and cells of several blocks, and no broadcasts."""
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    monkeypatch.setattr(near_dup, "BUCKET", 5)
    monkeypatch.setattr(near_dup, "PIVOTS", 2)
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", 0)
    rows = families(11, 6, 25)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_dup(docs(spark, *rows)).collect()}
    assert got == near_brute(rows)


def test_near_dup_null_and_repeated_ids(spark):
    text = "a b c d e f g h"
    got = near_dup.near_dup(docs(spark, (None, text), (None, text), (4, text), (4, text), (9, text))).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (-1, -1, True), (4, 4, True), (4, 4, True), (9, 4, False)]


def test_near_dup_thousands_of_repeats(spark):
    """One row 5,000 times, and another document with many texts: linear work."""
    text, other = "a b c d e f g h", "k l m n o p q r s"
    rows = [(4, text)] * 5000 + [(7, text)] + [(9, f"{other} {k} t u v w {k}") for k in range(300)]
    got = near_dup.near_dup(docs(spark, *rows)).groupBy("doc_id", "n_shingles", "component_id", "kept").count().collect()
    assert sorted(tuple(r) for r in got) == [(4, 4, 4, True, 5000), (7, 4, 4, False, 1), (9, 11, 9, True, 300)]


def test_near_dup_joins_the_texts_of_a_document(spark):
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "some other words that stand alone here")
    got = near_dup.near_dup(docs(spark, (1, a), (2, b), (5, a), (5, b), (6, c), (5, c), (8, "apart from all of that"))).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (5, 1), (6, 1), (8, 8)}


def test_near_dup_of_large_buckets_of_unlike_documents(spark, monkeypatch):
    """A passage that unlike documents share fills large buckets, whose near copies are found by their rare shingles."""
    monkeypatch.setattr(near_dup, "BUCKET", 8)
    monkeypatch.setattr(near_dup, "PIVOTS", 1)
    rng = random.Random(12)
    passage = ["p%d" % k for k in range(60)]
    rows = []
    for k in range(90):
        own = passage + ["x%d" % rng.randint(0, 10**6) for _ in range(40)]
        rows += [(3 * k, " ".join(own))]
        if k % 9 == 0:
            own[70] = "changed"
            rows += [(3 * k + 1, " ".join(own))]
    rows += [(1001, "own words of a text with two texts"), (1001, rows[0][1])]
    prefix, used = near_dup._prefix_pairs, []
    monkeypatch.setattr(near_dup, "_prefix_pairs", lambda rest, data: used.append(data) or prefix(rest, data))
    for broadcast in (near_dup.BROADCAST_ROWS, 0):
        monkeypatch.setattr(near_dup, "BROADCAST_ROWS", broadcast)
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_dup(docs(spark, *rows)).collect()}
        want = {(d, n, c) for d, (n, c) in near_brute(rows[:-2]).items()}
        assert got == want | {(1001, 4, 0), (1001, 96, 0)} and any(d != c for d, _, c in got)
    assert any("sig" in data for data in used)


def test_keys_meet_within_the_distance():
    """The pigeonhole guarantee: signatures that differ in up to DISTANCE symbols share keys of two chunks."""
    rng = np.random.default_rng(4)
    for k in range(300):
        a = rng.integers(0, 1 << 32, near_dup.SYMBOLS, np.uint64).astype(np.uint32)
        b = a.copy()
        gone = rng.choice(near_dup.SYMBOLS, near_dup.DISTANCE, replace=False)
        if k % 2:  # the worst case: two symbols of every chunk but one
            gone = [np.flatnonzero(near_dup.CHUNK_OF == c)[j] for c in rng.permutation(near_dup.CHUNKS)[1:] for j in range(2)][: near_dup.DISTANCE]
        b[gone] ^= 1
        x, y = near_dup.chunk_keys(np.stack([a, b]))
        assert len(set(near_dup.CHUNK_OF[x == y].tolist())) >= 2


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    want = {(x, find(x)) for x in up if find(x) != x}
    assert {tuple(r) for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()} == want


def check_packing(rows, size, got, lengths):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= size
    for d, own in pieces.items():
        assert sorted(own) == [(k, s, min(size, lengths[d] - s)) for k, s in enumerate(range(0, lengths[d], size))]
    return len(sequences)


def test_packing(spark, word_tokenizer):
    rows = sample(n=150)
    path, size = queries.vocabulary("word_bpe_49k.json"), 64
    ids = {d: np.array([*word_tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4") for d, t in texts(rows)}
    lengths = {d: len(i) for d, i in ids.items()}
    got = packing.pack(packing.cut_up(docs(spark, *rows), path, size), size).collect()
    used = check_packing(rows, size, got, lengths)
    assert used <= -(-sum(lengths.values()) // size) + 1
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) for r in got)
    islands = packing.pack(packing.cut_up(docs(spark, *rows), path, size), size, island=40).collect()
    assert check_packing(rows, size, islands, lengths) <= used + 2 and len(islands) == len(got)


def test_packing_repeated_rows(spark):
    got = packing.pack(packing.cut_up(docs(spark, *[(1, "a b")] * 5, (None, None)), queries.vocabulary("word_bpe_49k.json"), 4), 4).collect()
    assert len(got) == 6 and len({(r.sequence_id, r.offset) for r in got}) == 6 and sum(r.length for r in got) == 16


def test_crossover_keeps_every_piece():
    rng = random.Random(8)
    lengths = [rng.randint(1, 2047) for _ in range(400)]
    breeder = packing.Breeder(lengths, 2048, 1)
    a, b = breeder.best_fit([], breeder.descending(list(range(400)), 0.9)), breeder.best_fit([], list(range(400)))
    for child in (breeder.crossover(a, b), breeder.mutate(a), breeder.settle(breeder.elites(b)), breeder.evolve([a, b])):
        assert sorted(p for s in child for p in s) == list(range(400))
        assert all(breeder.fill(s) <= 2048 for s in child)
    assert len(breeder.evolve([a, b])) <= min(len(a), len(b))


def test_crossover_improves_the_seed(monkeypatch):
    rng = random.Random(10)
    lengths = [rng.randint(250, 500) for _ in range(120)]
    monkeypatch.setattr(packing.Breeder, "mutate", lambda self, own: [list(s) for s in own])  # crossover alone
    made = lambda: packing.Breeder(lengths, 1000, 1)
    greedy = made().best_fit([], made().descending(list(range(120))))
    first, bred = made().evolve([], 0), made().evolve([])
    assert sorted(p for s in bred for p in s) == list(range(120)) and all(made().fill(s) <= 1000 for s in bred)
    assert made().bound <= len(bred) < len(first) <= len(greedy)


def brute_tree(text):
    """Sections, paragraphs and pieces, cut by walking over the text."""
    import regex

    ends = regex.compile(r"\p{P}|[!-/:-@\[-`{-~]")
    latin = regex.compile(r"\p{Script=Latin}")

    def pieces(p):
        out, at = [], 0
        while at < len(p):
            for k in range(at + merkle.LEAST - 1, min(at + merkle.MOST, len(p))):
                if ends.match(p[k]) or (p[k] in " \t\x0b\x0c\r" and (p[k - 1] in "es" or not latin.match(p[k - 1]))):
                    out.append(p[at : k + 1])
                    break
            else:
                out.append(p[at : at + merkle.MOST])
            at += len(out[-1])
        return out

    return [[pieces(p) for p in s.split("\n")] for s in text.split("\n\n")]


def brute_fingerprint(text):
    short = lambda node, n: base64.b64encode(bytes.fromhex(node[: n * 3 // 2])).decode()
    sections, nodes = [], []
    for s in brute_tree(text):
        paragraphs = []
        for p in s:
            leaves = [hashlib.md5(x.encode()).hexdigest() for x in p]
            paragraphs.append((sha("p" + "".join(leaves)), "".join(short(x, 4) for x in leaves)))
        nodes.append(sha("s" + "".join(n for n, _ in paragraphs)))
        sections.append(f"{short(nodes[-1], 8)}:" + ".".join(f"{short(n, 8)}-{x}" for n, x in paragraphs))
    return sha("r" + "".join(nodes)) + "|" + ";".join(sections)


def brute_likeness(a, b):
    x, y = ({hashlib.md5(p.encode()).hexdigest()[:6] for s in brute_tree(t) for q in s for p in q} for t in (a, b))
    return 1.0 if a == b else 2 * len(x & y) / max(1, len(x) + len(y))


def check_edit_study(got, order, ties=False):
    by_text = {}
    for n, (d, t) in enumerate(order):
        onward, half = order[(n + 1) % len(order)][1], len(t) // 2
        edited = t[: len(t) - half] + onward[:half]
        want = (d, len(t), sha(edited), brute_fingerprint(t), brute_fingerprint(edited), round(brute_likeness(t, edited), 9), round(brute_likeness(t, onward), 9))
        assert got[want] > 0, want
        got[want] -= 1
        by_text.setdefault(t, set()).add(want[3])
    assert not +got and len({f[:64] for s in by_text.values() for f in s}) == len(by_text)


def studied(df):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in merkle.edit_study(df).collect())


def test_merkle(spark):
    long = " ".join("word%d is here, and more" % (k % 700) for k in range(6000))
    rows = [*sample(n=25), (20_000, "a\n\nb\nc"), (40_000, "x"), (40_001, "é" * 700), (40_002, "日本語の文。" * 60), (50_000, long), (50_001, long[:50_000] + "inserted " + long[50_000:])]
    check_edit_study(studied(docs(spark, *rows)), sorted(texts(rows)))


@pytest.mark.parametrize("hot", [20_000, 3])
def test_merkle_null_repeated_and_sparse_ids(spark, monkeypatch, hot):
    """Buckets split by doc_id, hash and tie give the same order; rows with equal ids follow a hash of their texts."""
    monkeypatch.setattr(merkle, "HOT", hot)
    rows = [*sample(n=20), *[(None, f"no id {k}") for k in range(8)], *[(33, f"many texts of one id {k}") for k in range(9)], *[(70, "the same row again")] * 7, *[(k * 2**44 + 5, f"far apart {k}") for k in range(1, 30)]]
    df = docs(spark, *rows)
    keyed = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    order = [(r.doc_id, r.text) for r in sorted(keyed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))]
    check_edit_study(studied(df), order)


def test_merkle_insertion_changes_a_few_pieces(spark):
    """One inserted character: without cuts by content no piece after it would be left."""
    rng = random.Random(3)
    a = " ".join(rng.choice(["houses", "the", "river", "one", "under", "lines", "a"]) + str(k) for k in range(400))
    df = spark.createDataFrame([(a, a[:300] + "!" + a[300:])], "x string, y string")
    for c in ("x", "y"):
        df = merkle.with_fingerprint(df, c, f"f{c}").withColumn(f"p{c}", F.array_distinct(merkle.pieces_of(F.col(f"f{c}"))))
    got = df.select(merkle.likeness(F.col("fx"), F.col("fy"), F.col("px"), F.col("py")).alias("near"), F.length("fx").alias("n")).first()
    assert 0.8 < got.near < 1 and got.n < 65 + 0.25 * len(a)


def test_merkle_successors(spark):
    keys = sorted({-(2**50), -1, 0, 1, 5, 1023, 1024, 5000, 2**33, 2**33 + 1, 2**60})
    got = dict(map(tuple, merkle.successors(spark.createDataFrame([(k,) for k in keys], "key long")).collect()))
    assert got == dict(zip(keys, [*keys[1:], None], strict=True))


def test_merkle_locates(spark):
    a, b = "one\ntwo\n\nthree\nfour", "one\ntwo\n\nthree\nFOUR\nfive"
    df = spark.createDataFrame([(1, a, b), (2, a, a)], "id int, x string, y string")
    for c in ("x", "y"):
        df = merkle.with_fingerprint(df, c, f"f{c}")
    assert sorted((r.id, r.section, r.paragraph) for r in merkle.locate(df, "fx", "fy").collect()) == [(1, 1, 1), (1, 1, 2)]


def test_exact_dedup(spark):
    rows = sample() + [(800 + k, "p" * 300 + str(k % 3)) for k in range(9)] + [(900 + k, "q" * 299 + str(k)) for k in range(4)]
    groups = defaultdict(list)
    for d, t in texts(rows):
        groups[t].append(d)
    want = {d: (max(g), len(g), d == max(g)) for g in groups.values() for d in g}
    df = docs(spark, *rows)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect()} == want
    kept = exact_dedup.keep_rows(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d, v in want.items() if v[2])


def test_exact_dedup_null_and_repeated_ids(spark):
    df = docs(spark, (None, "a"), (None, "b"), (3, "a"), (3, "a"), (2, None), (2, ""))
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect())
    assert got == [(-1, -1, 1, True), (-1, 3, 3, False), (2, 2, 2, True), (2, 2, 2, True), (3, 3, 3, True), (3, 3, 3, True)]
    assert sorted((r.doc_id or -1, r.text or "") for r in exact_dedup.keep_rows(df).collect()) == [(-1, "b"), (2, ""), (3, "a")]


def toxic_world(n=1200, seed=2):
    """Toxic: an insult together with a group; neither alone is."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = ["w%d" % rng.randint(0, 60) for _ in range(20)]
        kind = k % 4
        words += {0: ["insulto"], 1: ["grupo"], 2: ["insulto", "grupo"], 3: []}[kind]
        rng.shuffle(words)
        rows.append((k, " ".join(words), int(kind == 2)))
    return rows


def test_toxicity_learns_pairs(spark):
    rows = toxic_world()
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int").filter(~toxicity.held_out())
    df = docs(spark, *[(d, t) for d, t, _ in rows], (5000, None), (5001, ""))
    model = toxicity.fit(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), labels)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    held = {d for d, _, _ in rows if zlib.crc32(str(d).encode()) % 5 == 0}
    right = [(got[d] >= 0.5) == bool(y) for d, _, y in rows if d in held]
    assert len(right) > 150 and sum(right) / len(right) > 0.97
    assert got[5000] == got[5001] < 0.5
    assert {r.doc_id for r in toxicity.keep_clean(df, model).collect()} == {d for d, s in got.items() if s < 0.5}


def test_toxicity_scores_are_plain_sums(spark):
    """Every score against the machine written out: the bias, each term, each pair of terms."""
    rng = np.random.default_rng(7)
    words = ["insulto", "grupo", "calm", "word", "Été", "another-one", "x"]
    rows = sorted({r for w in words for r in toxicity.word_terms(w)})[::2]
    model = toxicity.Model(-0.3, {r: i for i, r in enumerate(rows)}, rng.normal(0, 1, len(rows)), rng.normal(0, 0.7, (len(rows), 3)))
    table = [(k, " ".join(rng.choice(words, rng.integers(0, 9))) + "," * (k % 2)) for k in range(60)] + [(None, None), (70, "calm insulto " * 40_000), (70, "GRUPO! grupo"), (70, "GRUPO! grupo")]
    got = Counter((r.doc_id, round(r.score, 9)) for r in toxicity.score(docs(spark, *table), model).collect())
    want = []
    for d, t in texts(table):
        own = sorted({model.terms[r] for w in t.split() for r in toxicity.word_terms(w) if r in model.terms})
        raw = model.bias + sum(model.weights[i] for i in own) + sum(model.factors[i] @ model.factors[j] for n, i in enumerate(own) for j in own[:n])
        want.append((d, round(1 / (1 + np.exp(-raw)), 9)))
    assert got == Counter(want)


def test_toxicity_keeps_pairs_that_say_nothing_alone():
    """Toxic: exactly one of two words that are as common in clean documents. A marginal choice of terms would drop both."""
    rng = np.random.default_rng(9)
    found, toxic = [], []
    for k in range(2400):
        own = set(rng.integers(10, 70, 12).tolist()) | ({1} if k % 4 in (0, 1) else set()) | ({2} if k % 4 in (0, 2) else set())
        found.append(np.array(sorted(own), np.int32))
        toxic.append(int(k % 4 in (1, 2)))
    counts = np.array([len(f) for f in found])
    model = toxicity.fit_rows(np.concatenate(found), counts, np.array(toxic))
    raw = toxicity.raw_scores(model, [np.array([model.terms[r] for r in f.tolist() if r in model.terms], np.int64) for f in found])
    linear = toxicity.fit_rows(np.concatenate(found), counts, np.array(toxic), k=0)
    plain = toxicity.raw_scores(linear, [np.array([linear.terms[r] for r in f.tolist() if r in linear.terms], np.int64) for f in found])
    share = lambda x: ((x > 0) == np.array(toxic)).mean()
    assert {1, 2} <= set(model.terms) and share(raw) > 0.97 > 0.7 > share(plain)


def test_toxicity_of_repeated_and_null_ids(spark):
    rows = toxic_world(400)
    labels = [(d, y) for d, _, y in rows] + [(0, 1), (None, 1), (8, None)]
    df = docs(spark, *[(d, t) for d, t, _ in rows], *[(rows[2][0], rows[2][1])] * 3, (None, "insulto grupo"))
    model = toxicity.fit(common.id_text(df), spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = [r.score for r in toxicity.score(df, model).filter(F.col("doc_id") == rows[2][0]).collect()]
    assert len(scores) == 4 and len(set(scores)) == 1


def test_toxicity_without_labels(spark):
    df = docs(spark, (1, "a b"), (2, None)).select("doc_id", "text")
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    scores = {r.score for r in toxicity.score(df, toxicity.fit(df, none)).collect()}
    assert scores == {0.5}
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert all(r.score < 0.5 for r in toxicity.score(df, toxicity.fit(df, one)).collect())


@pytest.mark.parametrize(
    "make",
    [
        lambda d: line_dedup.apply_bitmaps(d, line_dedup.line_dedup(d)),
        lambda d: token_count.count_tokens(d, queries.vocabulary("byte_bpe_50k.json")),
        lambda d: byte_bpe.round_trip(d, queries.vocabulary("byte_bpe_50k.tiktoken")),
        near_dup.near_dup,
        near_dup.keep_rows,
        queries.packed,
        merkle.edit_study,
        merkle.fingerprints,
        exact_dedup.exact_dedup,
        exact_dedup.keep_rows,
        lambda d: toxicity.score(d, toxicity.Model(0.0, {}, np.zeros(0), np.zeros((0, 4)))),
        lambda d: url_filter.filter_urls(d.withColumnRenamed("text", "url"), [("block", "com", "")], id_col="doc_id"),
    ],
)
def test_empty_tables(spark, make):
    assert make(docs(spark)).collect() == []


def test_empty_token_files(spark):
    target = scratch_path(spark, "test-empty")
    token_files.write_token_files(docs(spark), queries.vocabulary("word_bpe_49k.json"), target)
    assert token_files.read_digests(spark, target).collect() == []


def plain_scan(text, templates, base, covered=0.8, drift=4):
    """Every place and every diagonal compared one by one."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in low).split(" ")
    words = [w for w in words if w]
    places = [(k, label) for label, p in base for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    labels, score = {label for _, label in places}, 0.0
    for label, phrase in (*base, *templates):
        p = phrase.split()
        hits = [(k - a, a) for k in range(len(words) - 2) for a in range(len(p) - 2) if words[k : k + 3] == p[a : a + 3]]
        for d in {d for d, _ in hits}:
            share = len({a + j for e, a in hits for j in range(3) if abs(e - d) <= drift}) / len(p)
            score = max(score, share)
            if share >= covered:
                labels.add(label)
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), score)


def license_rows():
    notice = license_scan.NOTICES[1][1].split()
    rng = random.Random(5)
    rows = sample(n=20) + [
        (700, "Released under the MIT License. And CC BY-NC 4.0; cc\tby_nc"),
        (701, "APACHE license, VERSION 2! apache license version 2.0"),
        (701, "APACHE license, VERSION 2! apache license version 2.0"),
        (702, "under the mit licence"),
        (703, "cc by"),
        (704, "CC BY NC " * 3000),
        (705, "word " + " ".join(notice[:10] + ["new", "words"] + notice[11:])),
        (706, " ".join(notice[:8])),
        (707, "éunder the mit license under the mit licenseé"),
        (None, "x cc by nc"),
        (708, "gnu general public license, gnu lesser general public license"),
    ]
    return rows + [(800 + k, " ".join(w for w in rng.choice(license_scan.NOTICES)[1].split() if rng.random() < 0.93)) for k in range(60)]


def test_license_scan(spark, monkeypatch):
    rows = license_rows()
    df, key = docs(spark, *rows).repartition(5), lambda r: (str(r[0]), *map(str, r[1:]))
    want = sorted([(d, *plain_scan(t, license_scan.NOTICES, license_scan.BASE)) for d, t in rows], key=key)
    grams = license_scan.template_grams(spark)
    assert sorted(map(tuple, license_scan.scan(df, grams).collect()), key=key) == want
    by_id = {r[0]: r for r in want}
    assert by_id[704][2] == 3000 and by_id[705][6] == "mit" and by_id[706][6] == "" and by_id[701][2] == 2 and by_id[708][6] == "gpl,lgpl"
    monkeypatch.setattr(license_scan, "BROADCAST_GRAMS", 0)
    monkeypatch.setattr(license_scan, "BROADCAST_DOCS", 0)
    plain = license_scan.scan(df, license_scan.template_grams(spark))
    assert sorted(map(tuple, plain.collect()), key=key) == want
    assert license_scan.scan(docs(spark), grams).count() == 0
    with pytest.raises(ValueError):
        license_scan.template_rows([("x", "two words")], [])


def test_license_spans(spark):
    text = "a b c this is free and unencumbered new software released into the public domain z"
    best = license_scan.spans(docs(spark, (1, text)), license_scan.template_grams(spark)).filter("best and label = 'unlicense'").collect()
    assert [(r["first"], r["last"], r.place) for r in best] == [(3, 14, False)] and best[0].coverage == 1.0


def plain_search(rows, items, k=10):
    """Every item against every document, by Python's integers."""
    import re

    terms = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    corpus = [(d, Counter(terms(t))) for d, t in rows]
    corpus = [(d, c, sum(c.values())) for d, c in corpus if c]
    n, total = len(corpus), sum(s for _, _, s in corpus)
    df = Counter(t for _, c, _ in corpus for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, size in corpus:
            m = 25 + (75 * size * n) // total
            score = sum(int(np.floor(1000 * np.log((2 * n + 2) / (2 * df[t] + 1)))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def test_lexical_search(spark, monkeypatch):
    rows = sample(seed=8, n=120) + [(d, "same TEXT, twice") for d in (4000, 4001, 4002, 4002, None)] + [(4100 + k, "tie " * 3) for k in range(15)]
    items = [(1, "alpha beta Δελτα Δελτα"), (2, "TIE"), (2, "tie same"), (3, None), (4, ""), (5, "nowhere-to be found"), (None, "été 日本 x1 text"), (7, "the " * 300 + "gamma")]
    df = docs(spark, *rows).repartition(7)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id long, score long")
    got = lambda: sorted(map(tuple, lexical_search.search(df, asked).collect()), key=str)
    want = plain_search(rows, items)
    assert got() == want and len(want) > 40
    assert [(r, d) for i, r, d, _ in want if i == 2 and d and 4100 <= d < 4115][:1] == [(1, 4100)]
    monkeypatch.setattr(lexical_search, "ITEM_TERMS", 4)
    monkeypatch.setattr(lexical_search, "TRIPLES", 5)
    assert got() == want
    assert lexical_search.search(docs(spark), asked).count() == 0 and lexical_search.search(df, asked.limit(0)).count() == 0


def test_lexical_parts():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 50, 5000).astype(np.uint64) >> rng.integers(0, 40, 5000).astype(np.uint64)
    assert (lexical_search.radix_order(keys) == np.argsort(keys, kind="stable")).all()
    items, at, value = rng.integers(0, 9, 4000), rng.integers(0, 50, 4000), rng.integers(1, 10**12, 4000)
    want = Counter()
    for i, d, v in zip(items.tolist(), at.tolist(), value.tolist(), strict=True):
        want[i, d] += v
    assert list(zip(*(c.tolist() for c in lexical_search.accumulate(items, at, value, 50)), strict=True)) == sorted((i, d, v) for (i, d), v in want.items())
    assert lexical_search.length_part(np.array([7, 10**12]), 10**9, 3 * 10**15).tolist() == [25 + 75 * 7 * 10**9 // (3 * 10**15), 25 + 75 * 10**21 // (3 * 10**15)]
    assert lexical_search.terms_of("A-b_C é~Ω9\x7f\x00".encode()) == ["a".encode(), b"b", b"c", "é".encode(), "Ω9".encode()]


def plain_repair(rows):
    """(counts, cost, audit, hash) of ordered (turn, role, text): the least (cost, letters) over all prefixes and states."""
    import re

    white = " \t\n\x0b\x0c\r"
    faults, seen = [], set()
    for _, role, text in rows:
        seen_before, end = (role, text) in seen, text.strip(white)[-1:]
        faults.append("blank" if not end else "duplicate" if seen_before else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    ini = [r[:1] for _, r, _ in rows]
    legal = lambda s: re.fullmatch("(s?(ua)+)?", s) is not None
    start = lambda s: re.fullmatch("s?(ua)*u?", s) is not None
    state = lambda s: (s[:1] == "s" and len(s) == 1, s[-1:] == "u", bool(s))
    best = {(0, state("")): (0, "", "", ())}
    queue = {0: dict(best)}
    for i in range(len(rows) + 1):
        now = queue.get(i, {})
        todo = list(now.values())
        while todo:  # insertions stay at the row
            cost, letters, out, lines = todo.pop()
            for x, name in (("u", "user"), ("a", "assistant")):
                if start(out + x) and cost < 4 * len(rows) + 7:
                    new = (cost + 3, letters + "I", out + x, (*lines, name + ":"))
                    if new[:2] < now.get((i, state(out + x)), (9**9, ""))[:2]:
                        now[i, state(out + x)] = new
                        todo.append(new)
        if i == len(rows):
            break
        after = queue.setdefault(i + 1, {})
        for cost, letters, out, lines in now.values():
            role, text = rows[i][1:]
            late = 3 * (faults[i] == "truncated")
            ways = [(cost + 4, letters + "D", out, lines)]
            if faults[i] in ("", "truncated"):
                ways += [(cost + late, letters + "K", out + ini[i], (*lines, f"{role}:{text}"))] if ini[i] in "sua" and ini[i] and start(out + ini[i]) else []
                ways += [(cost + 3 + late, letters + "R", out + x, (*lines, f"{name}:{text}")) for x, name in (("u", "user"), ("a", "assistant")) if start(out + x)]
            for new in ways:
                if new[:2] < after.get((i + 1, state(new[2])), (9**9, ""))[:2]:
                    after[i + 1, state(new[2])] = new
    cost, letters, _, lines = min(w for w in queue[len(rows)].values() if legal(w[2]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(ini, ini[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, sha("\n".join(lines)))


def talks():
    rng = random.Random(4)
    pool = ["Fine.", "And so", "Why?", " \t", "", "No!  ", "é。", "x" * 50 + ".", "twice."]
    rows = []
    for c in range(60):
        n = rng.choice([1, 2, 3, 5, 9, 14])
        for t in range(n):
            turn = rng.choice([None, t, t, t + rng.randint(0, 2)])
            rows.append((c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sudo"]), rng.choice([*pool, f"text {t}.", f"text {t}", f"{c}-{t}!", None])))
    rows += [(None, 1, "user", "a."), (None, 2, "user", "b."), (None, 5, "assistant", "c."), (200, 0, "user", "same."), (200, 0, "user", "same."), (200, None, "user", "same.")]
    return rows + [(300, t, ("user", "assistant")[(t + t // 7) % 2], f"row {t % 50}" + ".!"[t % 2] * (t % 3 > 0)) for t in range(400)]


def wanted_repairs(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, " " if r is None else r, " " if x is None else x))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return sorted(((c, *plain_repair(sorted(own, key=order))) for c, own in by.items()), key=str)


def test_conversation_repair(spark, monkeypatch):
    rows = talks()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, fault int, chunk long").repartition(6)
    got = lambda: sorted(map(tuple, conversation_repair.repair(df).collect()), key=str)
    want = wanted_repairs(rows)
    assert got() == want
    assert {letter for r in want for letter in r[7]} == set("DIKR")
    monkeypatch.setattr(conversation_repair, "LONG_ROWS", 4)  # most conversations by chunks
    assert got() == want
    monkeypatch.setattr(conversation_repair, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(conversation_repair, "LONG_BYTES", 20)
    assert got() == want
    assert conversation_repair.repair(df.limit(0)).count() == 0


def test_conversation_dropped_rows(spark, monkeypatch):
    rows = [(1, 0, "user", "Hm."), (2, 0, "user", "Hm."), (2, 1, "assistant", "Oh.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for limit in (conversation_repair.LONG_ROWS, 0):
        monkeypatch.setattr(conversation_repair, "LONG_ROWS", limit)
        monkeypatch.setattr(conversation_repair, "LONG_BYTES", 10**9)
        if not limit:  # chunks are sized by it
            monkeypatch.setattr(conversation_repair, "LONG_ROWS", 0.5)
        found = {r.conv_id: tuple(r)[1:] for r in conversation_repair.repair(df, dropped=F.col("conv_id") == 1).collect()}
        assert found == {1: (0, 0, 0, 0, 0, 0, "", sha("")), 2: (0, 0, 0, 0, 0, 0, "KK", sha("user:Hm.\nassistant:Oh."))}


def test_conversation_damage(spark):
    rows = [(c, t, "assistant", "Yes. No!") for c in range(40) for t in range(4)] + [(None, None, None, None), (7, None, None, "a.b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id, r.turn, r.role, r.text, r.dropped) for r in conversation_repair.damaged(df).collect() if r.conv_id is not None and r.turn is not None)
    want = []
    for c, t, role, text in rows[:-2]:
        code = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = {1: "", 2: "Yes No"}.get(code, text)
        want += [(c, t, "user" if code == 4 else role, text, code == 0)] * (1 + (code == 3))
    assert got == sorted(want) and len(want) > 160


def test_near_dup_of_a_template(spark, monkeypatch):
    """Documents that share a passage, alike by half to nearly three quarters, some of them truly near: cells larger than a block."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    monkeypatch.setattr(near_dup, "PIVOTS", 2)
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for d in range(150):
        own = [word() for _ in range(rng.choice([14, 18, 22, 40]))]
        rows.append((d, " ".join(passage + own)))
        if d % 9 == 0:
            own[rng.randrange(len(own))] = word()
            rows.append((1000 + d, " ".join(passage + own)))
    rows += [(2000, " ".join(passage)), (2001, " ".join(passage[:50]))]
    want = near_brute(rows)
    prefix, used = near_dup._prefix_pairs, []
    monkeypatch.setattr(near_dup, "_prefix_pairs", lambda rest, data: used.append(prefix(rest, data)) or used[-1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_dup(docs(spark, *rows)).collect()}
    assert got == want and len({c for _, c in want.values()}) > 20 and any(d != c for d, (_, c) in want.items())
    assert used and used[0].agg(F.max("a"), F.max("b")).first() != (0, 0)  # groups of more than a block as well


def test_forests_of_equal_sets():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 400).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[k : k + 90], rng.integers(0, 1 << 60, 5).astype(np.uint64)])) for k in (0, 2, 4, 200, 203, 300)]
    linked = {(i, j) for i in range(6) for j in range(i + 1, 6) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    for own in (list(range(6)), [0, 0, 2, 3, 4, 5], [9] * 6):
        forest = near_dup.exact_forest(sets, own)
        union = near_dup.Union(6)
        [union.join(i, own.index(own[i])) for i in range(6)]
        assert all(pair in linked for pair in forest) and all(union.join(i, j) for i, j in forest)
        assert all(not union.join(i, j) for i, j in linked)


def test_a_repeated_labelled_row_is_fitted_once(spark):
    rows = [(k, f"{'vile rude' if k % 2 else 'kind fair'} word{k} text") for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    once = toxicity.fit(common.id_text(docs(spark, *rows)), labels)
    many = common.id_text(docs(spark, *rows, *rows[:3] * 400))
    twice = toxicity.fit(many, labels)
    assert once.terms == twice.terms and once.bias == twice.bias and (once.weights == twice.weights).all() and (once.factors == twice.factors).all()
    assert toxicity.fit(many, labels, max_terms=300).bias != once.bias and not toxicity.fit(many, labels, max_terms=1).terms


def test_line_dedup_of_a_repeated_row(spark, monkeypatch):
    """One row many times, below and above the limit, beside others with its lines; repeats don't meet in a task."""
    rows = [(1, "a\nb")] * 7 + [(2, "b\nc")] * 3 + [(3, "c\nd\nc")] * 12 + [(None, "e\nA")] * 4 + [(5, "lonely")]
    held = Counter(x.lower() for _, t in rows for x in set(t.split("\n")))
    want = Counter((d, len(t.split("\n")), sha("\n".join(x for x in t.split("\n") if held[x.lower()] < 10))) for d, t in rows)
    df = docs(spark, *rows).repartition(5)
    for limit in (line_dedup.BROADCAST_REPEATS, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_REPEATS", limit)
        got = Counter((r.doc_id, r.n_lines, sha(r.kept_text)) for r in line_dedup.apply_bitmaps(df, line_dedup.line_dedup(df, 10)).collect())
        assert got == want
    assert max(Counter(map(tuple, line_dedup._once(line_dedup.id_text(df).selectExpr("doc_id", "xxhash64(text) as rid", "text"), 10).select("doc_id", "times").collect())).values()) == 1


def test_a_range_of_ids_is_decoded_by_offsets(spark):
    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    rows = [r for r in sample(seed=9, n=30) if r[0] is not None]
    encoded = byte_bpe.encode_texts(docs(spark, *rows), path)
    text, ids = dict(texts(rows)), {r.doc_id: r.ids for r in encoded.collect()}
    own = byte_bpe.coder(path)
    for first, last in ((0, 5), (3, 9), (2, 3), (5, 10**6), (10**6, 10**7), (4, 4), (-3, 2)):
        for r in byte_bpe.decode_range(encoded, path, F.lit(first), F.lit(last)).collect():
            a, b = max(0, first), max(0, last)
            assert bytes(r.data) == own.decode(ids[r.doc_id][a:b])
            if not ids[r.doc_id][a:b]:
                assert (r.begin, r.upto) == (None, None)
                continue
            before = len(own.decode(ids[r.doc_id][:a]).decode(errors="ignore"))
            assert r.begin == before and text[r.doc_id][r.begin : r.upto].encode().find(bytes(r.data)) in (0, *range(-1, 4))
            if bytes(r.data).decode(errors="ignore").encode() == bytes(r.data):
                assert text[r.doc_id][r.begin :].encode().startswith(bytes(r.data))
