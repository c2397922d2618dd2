"""Metrics by day, pages by seeking, samples without sorting all rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brightwire.operators import quality
from brightwire.plans import ops, parts, queries, serving
from brightwire.sources import store

AS_OF = datetime(2026, 4, 12)
FEED = (
    "article_id string, source_name string, title string, url string, serving_date date, published_at timestamp, ingested_at timestamp, happy_factor double, "
    "is_positive_feed_eligible boolean, exclusion_reason string, tone_score double"
)
BRONZE = "source_record_id string, ingestion_id string, ingested_at timestamp, bronze_run_accepted_row_count long, bronze_run_malformed_ratio double, raw_payload string"


def feed_rows(spark, days, n=40):
    out = []
    for d in days:
        for i in range(n):
            at = datetime(2026, 4, d, i % 24, i)
            reason = [None, "hard_deny_term", "below_threshold"][i % 3]
            out.append((f"a{d}-{i:03}", f"s{i % 4}", "t", "u", at.date(), None if i % 7 == 0 else at, at + timedelta(hours=1), round(50 + (i * 43 % 4000) / 100, 2), reason is None, reason, 1.0))
    return spark.createDataFrame(out, FEED)


def bronze_rows(spark, days):
    rows = [(f"r{d}-{i}", f"run{d}" if i < 5 else "long", datetime(2026, 4, d, i), None if d < 3 else 90 + d, None if d % 2 else 0.01 * d, '{"bronze_run_accepted_row_count": 7, "bronze_run_malformed_ratio": 0.5}' if d == 1 else None) for d in days for i in range(8)]
    return spark.createDataFrame(rows, BRONZE)


def silver_rows(spark, days):
    return spark.createDataFrame([(f"s{d}-{i}", datetime(2026, 4, d, i), i % 3 == 0) for d in days for i in range(12)], "article_id string, ingested_at timestamp, is_duplicate boolean")


def tables(spark, path, days):
    made = {}
    for name, rows, layout in (("bronze", bronze_rows, {"day_of": "ingested_at"}), ("silver", silver_rows, {"day_of": "ingested_at"}), ("feed", feed_rows, {"partition_by": ("serving_date",)})):
        df = rows(spark, days)
        made[name] = store.Table(spark, f"file://{path}/{name}", df.schema, **layout)
        made[name].replace(df)
    return made


def test_parts_of_new_days_give_the_whole(spark, tmp_path):
    days = range(1, 5)
    own, kept = tables(spark, tmp_path, days), parts.Parts(spark, f"file://{tmp_path}/parts", "timestamp")
    for layer, table in own.items():
        kept.refresh(layer, table, date(2026, 4, 1), date(2026, 4, 4))
    for layer, rows in (("bronze", bronze_rows), ("silver", silver_rows), ("feed", feed_rows)):
        own[layer].append(rows(spark, [5]))
        read = kept.refresh(layer, own[layer], date(2026, 4, 5), date(2026, 4, 5))
        assert {f.split("=")[-1][:10] for f in map(str, read.inputFiles())} == {"2026-04-05"} or all("2026-04-05" in str(f) for f in read.inputFiles())
    whole = [own[k].read() for k in ("bronze", "silver", "feed")]
    want = quality.run_metrics(*whole, as_of=AS_OF).first().asDict()
    assert parts.run_metrics(kept, as_of=AS_OF).first().asDict() == want
    assert want["latest_bronze_ingestion_accepted_row_count"] == 95 and want["gold_row_count"] == 200
    order = lambda df: sorted(map(str, df.select("section", "bucket", "bucket_order", "row_count").collect()))
    assert order(parts.pulse(kept)) == order(serving.pulse(whole[2]))


def test_parts_of_a_day_that_changed(spark, tmp_path):
    own, kept = tables(spark, tmp_path, range(1, 4)), parts.Parts(spark, f"file://{tmp_path}/parts", "timestamp")
    kept.refresh("feed", own["feed"], date(2026, 4, 1), date(2026, 4, 3))
    own["feed"].delete("serving_date = date'2026-04-02' and not is_positive_feed_eligible")
    kept.refresh("feed", own["feed"], date(2026, 4, 2), date(2026, 4, 2))
    got = {(r.section, r.bucket): r.row_count for r in parts.pulse(kept).collect()}
    assert got == {(r.section, r.bucket): r.row_count for r in serving.pulse(own["feed"].read()).collect()}
    assert got[("summary", "ineligible_row_count")] == 2 * 26


def test_layers_are_laid_out_by_day_with_the_columns_of_their_parts(spark, monkeypatch):
    made, replace = [], store.Table.replace
    monkeypatch.setattr(store.Table, "replace", lambda self, df: (made.append((tuple(df.columns), df.count())), replace(self, df))[1])
    t = queries.Tables(spark, "/root/testdata/sf0.001").once("bronze", "silver", "feed")
    found = queries._daily(t, "bronze", "silver", "feed")
    assert made == [(parts.READS[layer], getattr(t, layer).count()) for layer in ("bronze", "silver", "feed")]
    want = quality.run_metrics(t.bronze, t.silver, t.feed, as_of=queries.AS_OF).first().asDict()
    assert parts.run_metrics(found, as_of=queries.AS_OF).first().asDict() == want


def test_empty_parts(spark, tmp_path):
    kept = parts.Parts(spark, f"file://{tmp_path}/parts", "timestamp")
    assert {r.row_count for r in parts.pulse(kept).collect()} == {0}
    assert parts.run_metrics(kept, as_of=AS_OF).count() == 0  # no run has landed


@pytest.mark.parametrize("order", [serving.MOST_OPTIMISTIC, serving.LEAST_OPTIMISTIC])
def test_pages_by_seeking_equal_pages_by_offset(spark, order):
    feed = feed_rows(spark, range(1, 6)).withColumn("happy_factor", F.expr("case when article_id like '%1' then 70.0 else happy_factor end")).cache()
    feed = feed.withColumns({c: F.lit("x") for c in ("language", "mentioned_country_name")})
    scope, size = serving.Scope(30), 7
    ends = {r.page: serving.Seek(r.happy_factor, r.seen_at, r.article_id) for r in serving.page_ends(feed, scope, size, order, as_of=AS_OF).collect()}
    n = feed.filter("is_positive_feed_eligible").count()
    assert set(ends) == set(range(1, n // size + 1))
    for number in (1, 2, 5, n // size, n // size + 1):
        want = [r.article_id for r in serving.brief_rows(feed, scope, serving.Page(number, size, order), as_of=AS_OF).collect()]
        page = serving.brief_after(feed, scope, ends.get(number - 1), size, order, as_of=AS_OF)
        assert [r.article_id for r in page.collect()] == want
    assert "Offset" not in page._jdf.queryExecution().toString() and "happy_factor" in page._jdf.queryExecution().toString().split("Filter", 1)[1]


@pytest.mark.parametrize("k", [1, 20, 500, 5000])
def test_bottom_equals_a_window(spark, k):
    rows = spark.range(3000).select(F.concat(F.lit("a"), "id").alias("article_id"), F.when(F.col("id") % 300 == 0, "rare").when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("bucket"))
    order = F.sha2("article_id", 256)
    got = ops.bottom(rows, "bucket", order, k, "n")
    want = rows.withColumn("n", F.row_number().over(Window.partitionBy("bucket").orderBy(order)).cast("long")).filter(F.col("n") <= k)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
