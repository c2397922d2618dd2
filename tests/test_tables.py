"""Tables: which files a change touches, what it costs, what readers see."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brightwire.sources import store

START = datetime(2026, 4, 1)
SCHEMA = "k string, v long, seen_at timestamp"


def rows(spark, days=5, each=200, keys="k"):
    data = [(f"{keys}{d}-{i:04}", i, START + timedelta(days=d, minutes=i)) for d in range(days) for i in range(each)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    t = store.Table(spark, f"file://{tmp_path}/t", SCHEMA, sort_by=("k",), day_of="seen_at")
    t.replace(rows(spark))
    return t


def values(t):
    return sorted((r.k, r.v) for r in t.read().collect())


def day_of(file):
    return file.split("seen_at_day=")[1][:10]


def test_upsert_rewrites_only_files_with_its_keys(spark, table):
    before, want = set(table.files()), dict(values(table))
    batch = rows(spark).filter("k like 'k2-%' and v % 100 = 7").withColumn("v", F.col("v") + 1000)
    touched = table.upsert(batch, ["k"], ["seen_at"])
    assert {day_of(f) for f in touched} == {"2026-04-03"} and set(touched) < before
    assert before - set(touched) < set(table.files()) and not set(touched) & set(table.files())
    want |= {r.k: r.v for r in batch.collect()}
    assert values(table) == sorted(want.items())


def test_upsert_moves_rows_between_days_and_adds_new_ones(spark, table):
    moved = spark.createDataFrame([("k0-0001", -1, START + timedelta(days=4)), ("new", -2, START), (None, -3, None)], SCHEMA)
    touched = table.upsert(moved, ["k"])
    assert [day_of(f) for f in touched] == ["2026-04-01"]
    got = {r.k: r for r in table.read().collect()}
    assert len(got) == 1002 and got["k0-0001"].seen_at.day == 5 and got["new"].v == -2 and got[None].v == -3
    assert table.upsert(moved.filter("k = 'new'").withColumn("v", F.lit(9).cast("long")), ["k"]) and table.read().filter("k = 'new'").first().v == 9
    before = set(table.files())
    assert table.upsert(rows(spark, 1, 3, keys="z"), ["k"]) == [] and before < set(table.files())


def test_upsert_without_statistics_and_into_an_empty_table(spark, tmp_path):
    t = store.Table(spark, f"file://{tmp_path}/t", SCHEMA)
    assert t.upsert(rows(spark, 1, 5), ["k"]) == [] and t.read().count() == 5
    twice = rows(spark, 1, 1).unionAll(rows(spark, 1, 1).withColumn("v", F.lit(5).cast("long")).withColumn("seen_at", F.lit(START + timedelta(9))))
    assert len(t.upsert(twice, ["k"], ["seen_at"])) >= 1
    assert values(t)[0] == ("k0-0000", 5) and t.read().count() == 5


def test_delete_before_reads_only_straddling_files(spark, table, monkeypatch):
    before, read = set(table.files()), []
    scan = store.Table._scan
    monkeypatch.setattr(store.Table, "_scan", lambda self, paths: (read.append(list(paths)), scan(self, paths))[1])
    assert table.delete_before("seen_at", START + timedelta(days=2)) == 400
    assert all("=" in p and "/" not in p for paths in read for p in paths)  # no file of the table was read
    assert {day_of(f) for f in before & set(table.files())} == {"2026-04-03", "2026-04-04", "2026-04-05"} and set(table.files()) < before
    read.clear()
    assert table.delete_before("seen_at", START + timedelta(days=2, minutes=50)) == 50
    straddling = {p for paths in read for p in paths if "/" in p}
    assert straddling and {day_of(f) for f in straddling} == {"2026-04-03"}
    assert table.read().count() == 550 and table.delete_before("seen_at", START) == 0


def test_delete_by_condition_leaves_other_files(spark, table):
    before = set(table.files())
    assert table.delete("k like 'k1-%' or v < 10 and k like 'k3-%'") == 210
    gone = before - set(table.files())
    assert {day_of(f) for f in gone} == {"2026-04-02", "2026-04-04"} and table.read().count() == 790
    assert table.delete("v = 12345") == 0


def test_nulls_stay_when_rows_before_a_time_go(spark, table):
    table.append(spark.createDataFrame([("null", 0, None)], SCHEMA))
    assert table.delete_before("seen_at", "2027-01-01") == 1000
    assert values(table) == [("null", 0)]


def test_reads_are_pruned(spark, table):
    some = table.read("seen_at", START + timedelta(days=3), START + timedelta(days=3, minutes=10))
    assert some.count() == 11 and {day_of(f) for f in map(str, some.inputFiles())} == {"2026-04-04"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(seen_at_day" in plan and "PushedFilters: [IsNotNull(seen_at), GreaterThanOrEqual" in plan
    by_key = table.read("k", "k1-0003", "k1-0005")
    assert by_key.count() == 3 and {day_of(f) for f in map(str, by_key.inputFiles())} == {"2026-04-02"}


def test_a_large_day_is_spread_by_ranges(spark, tmp_path):
    t = store.Table(spark, f"file://{tmp_path}/t", SCHEMA, sort_by=("k",), day_of="seen_at")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t.replace(rows(spark, 1, 1200).unionAll(rows(spark, 3, 10, keys="z")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    first = t.manifest().filter("low_k like 'k%'").orderBy("low_k").collect()
    assert len(first) >= 3 and max(r.rows for r in first) < 700
    assert all(a.high_k < b.low_k for a, b in zip(first, first[1:], strict=False))


def test_versions_expire_and_plans_stay_readable(spark, table, tmp_path):
    old = table.read()
    table.upsert(rows(spark, 1, 5).withColumn("v", F.lit(-1).cast("long")), ["k"])
    assert old.count() == 1000 and old.filter("v < 0").count() == 0  # files of the version before are there
    for n in range(3):
        table.append(rows(spark, 1, 2, keys=f"x{n}"))
    on_disk = {str(p.relative_to(tmp_path / "t" / "data")) for p in (tmp_path / "t" / "data").rglob("*.parquet")}
    kept = set(table.files()) | {r.file for r in table.manifest(table.version() - 1).collect()}
    assert on_disk == kept and len(list((tmp_path / "t" / "manifest").iterdir())) == 2
    assert table.compact() > 3 and table.read().count() == 1006 and len(table.files()) <= 12


def test_a_failed_write_changes_nothing(spark, table):
    before, want = table.version(), values(table)
    bad = rows(spark, 1, 5).withColumn("v", F.raise_error(F.lit("no")).cast("long"))
    for change in (table.replace, table.append, lambda df: table.upsert(df, ["k"])):
        with pytest.raises(Exception, match="no"):
            change(bad)
    assert table.version() == before and values(table) == want


def test_partition_values_that_need_escapes(spark, tmp_path):
    t = store.Table(spark, f"file://{tmp_path}/t", "p string, v long", partition_by=("p",))
    t.replace(spark.createDataFrame([("a b", 1), ("c:d", 2), (None, 3), ("a%b", 4), ("é", 5)], t.schema))
    assert t.upsert(spark.createDataFrame([("c:d", 7)], t.schema), ["p"]) and sorted((str(r.p), r.v) for r in t.read().collect()) == [("None", 3), ("a b", 1), ("a%b", 4), ("c:d", 7), ("é", 5)]
    assert t.delete("v = 4") == 1 and t.read().count() == 4
