"""The pipeline's stages on a small corpus, against brute force; and the queries over the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from brightwire.llm import oracles, queries, toxicity
from brightwire.llm.common import cut

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_operators import check_packing, near_brute  # noqa: E402

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    scores = {r.doc_id: r.predicted for r in queries.op8_toxicity(spark, str(SF)).collect()}
    before, found = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, str(SF))
        rows = after.collect()
        own = {r.doc_id for r in before.collect()}
        if name == "toxicity":
            assert {r.doc_id for r in rows} == {d for d in own if not scores[d]} != own
        if name == "exact_dedup":
            last = {}
            for r in before.collect():
                last[r.text] = max(r.doc_id, last.get(r.text, -1))
            assert {r.doc_id for r in rows} == set(last.values())
        if name == "packing":
            assert {r.doc_id for r in rows} == own and "sequence_id" in after.columns
        else:
            assert after.columns == columns
        found[name], before = rows, after
    assert list(found) == ["toxicity", "exact_dedup", "near_dedup", "packing"]
    assert {r.doc_id for r in found["near_dedup"]} < {r.doc_id for r in found["exact_dedup"]}


def kept_near(rows):
    """Of (doc_id, text), the smallest doc_id of each group of near copies."""
    return {d for d, (_, c) in near_brute(rows).items() if d == c}


def test_run_against_brute_force(spark):
    """The whole pipeline: scores by the model's plain sums, last of equal texts, all pairs of sets, pieces of all that is left."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = queries.toxicity_model(spark, docs, str(SF))
    left = []
    for r in docs.collect():
        own = sorted({model.terms[t] for w in (r.text or "").split() for t in toxicity.word_terms(w) if t in model.terms})
        raw = model.bias + sum(model.weights[i] for i in own) + sum(model.factors[i] @ model.factors[j] for n, i in enumerate(own) for j in own[:n])
        if raw < 0:
            left.append((r.doc_id, r.text or ""))
    last = {t: d for d, t in sorted(left)}
    kept = kept_near([(d, t) for t, d in last.items()])
    library = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    lengths = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for t, d in last.items() if d in kept}
    rows = corpus_pipeline.run(spark, str(SF)).collect()
    want = {(d, k, at, min(2048, n - at)) for d, n in lengths.items() for k, at in enumerate(range(0, n, 2048))}
    assert {(r.doc_id, r.piece, r.start, r.length) for r in rows} == want and len(rows) == len(want)
    assert check_packing(None, 2048, rows, lengths) == -(-sum(lengths.values()) // 2048)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, component string, k_id long, tie long, group string, h long"


def table(spark, *rows):
    """Documents with further columns whose names the stages use themselves."""
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "x", "y", 1, 2, "z", 3) for d, t in rows], SCHEMA)


HARD = [(None, "without an id at all, this one"), (None, "without an id at all, this one"), (None, None), (3, None), (4, ""), (5, "same text here"), (6, "same text here"), (7, "one row twice"), (7, "one row twice"),
        (8, "very " * 60_000 + "long"), (9, "very " * 60_000 + "long"), (10, "a b c d e f g h"), (11, "A  b c d e f g\th")]


@pytest.mark.parametrize("rows", [HARD, []])
def test_stages_on_hard_rows(spark, tmp_path, rows):
    """Nulls, empty and very long texts, repeated rows, clashing names, an empty table; labels are missing, so nobody is toxic."""
    spark.createDataFrame([(1, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now, found = table(spark, *rows), {}
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES:
        now = cut(stage(spark, now, str(tmp_path)), name)
        found[name] = now.collect()
        assert name == "packing" or now.columns == columns
    if not rows:
        assert not any(found.values())
        return
    ids = lambda name: sorted((r.doc_id is not None, r.doc_id or 0) for r in found[name])
    no = (False, 0)
    assert sorted(r.doc_id or 0 for r in found["toxicity"]) == sorted(d or 0 for d, _ in rows)
    assert ids("exact_dedup") == [no, *((True, d) for d in (4, 6, 7, 9, 10, 11))]  # null and empty texts are equal: the largest doc_id of them stays
    assert ids("near_dedup") == [no, *((True, d) for d in (4, 6, 7, 9, 10))]
    assert {(r.doc_id, r.length) for r in found["packing"] if r.piece == 0 and r.doc_id == 4} == {(4, 1)}
    assert sum(r.length for r in found["packing"] if r.doc_id == 9) > 60_000


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    df = queries.queries()[name](spark, str(SF))
    cursor = con.execute(oracles.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(str([r[names.index(c)] for c in df.columns]) for r in cursor.fetchall())
    assert sorted(str(list(r)) for r in df.collect()) == want
