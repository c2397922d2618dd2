"""Registered queries against their DuckDB SQL, at the smallest scale factor; the driver compares all of them at sf0.01."""

import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from brightwire.plans import checks, oracles, pipeline, queries
from brightwire.sources import fixtures, store

SF = Path("/root/testdata/sf0.001")
NAMES = (
    "slv_dedup_rank slv_near_dup gld_feed gld_rule_hits v3_feed v3_explain agg_source_quality agg_metrics srv_brief_rows srv_pulse row_story_dedup "
    "ops_sample ops_compare chk_custom chk_column ext_country ext_domain src_batches url_due"
).split()
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


def test_every_query_has_sql():
    assert set(queries.queries()) - {"ext_lang_infer"} == set(oracles.oracle_sql())  # tests/test_language.py has the plain form of that one


def value(x):
    if isinstance(x, float):
        return repr(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return None if x is None else str(x)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(((tuple(value(r[i]) for i in order)) for r in rows), key=lambda r: tuple((x is None, x or "") for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, duck, name):
    df = queries.queries()[name](spark, str(SF))
    cursor = duck.execute(oracles.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("name", ["row_sorts_all", "chk_column_all", "ops_compare_all", "sink_export", "sink_delete", "sink_merge", "url_merge"])
def test_same_rows_of_whole_results(spark, duck, name):
    test_same_rows(spark, duck, name)


def test_every_row_comes_out_in_each_display_order(spark):
    per_order = {r.sort_order: r.n for r in queries.queries()["row_sorts_all"](spark, str(SF)).groupBy("sort_order").agg(F.count("*").alias("n")).collect()}
    feed = queries.queries()["gld_feed"](spark, str(SF)).count()
    assert feed > 50 and len(per_order) == 3 and set(per_order.values()) == {feed}


def test_every_declared_table_is_checked(spark):
    found = queries.queries()["chk_column_all"](spark, str(SF)).groupBy("table_name").agg(F.count("*").alias("n")).collect()
    counts = {r.table_name: r.n for r in found}
    assert set(counts) == {"bronze", "silver", "terms", "feed", "url_results", "source_quality", "shadow", "metrics", "labels"}
    assert (counts["shadow"], counts["metrics"], counts["labels"], counts["bronze"], counts["url_results"]) == (32, 8, 2, 9, 5)


def test_gate_covers_all_declared_tables(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(checks, "gate", lambda results: None)
    monkeypatch.setattr(checks, "column_checks", lambda df, declared: seen.append((set(declared) <= set(df.columns), declared)))
    labels = spark.createDataFrame([("a", "include")], "article_id string, default_feed_label string")
    bronze = fixtures.bronze(spark, str(SF))
    pipeline.build(spark, bronze, str(tmp_path), as_of=fixtures.AS_OF, labels=labels)
    assert all(known for known, _ in seen) and [d for _, d in seen] == list(checks.DECLARED.values())
    seen.clear()
    pipeline.build(spark, bronze, str(tmp_path / "two"), as_of=fixtures.AS_OF)
    assert [d for _, d in seen] == [d for n, d in checks.DECLARED.items() if n != "labels"]


def test_every_part_of_the_comparison(spark):
    parts = {r.part for r in queries.queries()["ops_compare_all"](spark, str(SF)).select("part").distinct().collect()}
    assert {"overlap", "shadow_exclusions", "shadow_domains", "current_precision", "shadow_precision"} <= parts


def test_sinks_go_through_their_operators(spark, monkeypatch):
    exported, deleted = [], []
    export, delete = store.export, store.Table.delete_before
    monkeypatch.setattr(store, "export", lambda df, path: (export(df, path), exported.append(path)))
    monkeypatch.setattr(store.Table, "delete_before", lambda self, column, cutoff: (deleted.append(delete(self, column, cutoff)), deleted[-1])[1])
    bronze = fixtures.bronze(spark, str(SF)).count()
    out = queries.queries()["sink_export"](spark, str(SF)).count()
    left = queries.queries()["sink_delete"](spark, str(SF)).count()
    assert out == spark.read.parquet(*exported).count() > 0
    assert deleted == [out] and left == bronze - out
