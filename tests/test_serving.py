"""Serving queries and row operators on small inputs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from brightwire.plans import ops, serving

FEED = (
    "article_id string, source_name string, title string, url string, serving_date date, published_at timestamp, ingested_at timestamp, happy_factor double, "
    "is_positive_feed_eligible boolean, exclusion_reason string"
)


def story(k, title="t", url=None, score=70.0, eligible=True, reason=None, day=1, source="A"):
    return k, source, title, url, date(2026, 4, day), datetime(2026, 4, day, 5), datetime(2026, 4, day, 6), score, eligible, reason


def rows(spark, *stories):
    return spark.createDataFrame(list(stories), FEED)


def test_configuration():
    scope, page = serving.Scope(90, (" FR", "EN", "EN", ""), ()), serving.Page(3, 10, "odd")
    assert (scope.lookback_days, scope.languages, page.offset, page.order) == (30, ("EN", "FR"), 20, serving.MOST_OPTIMISTIC)
    assert serving.Page(0, 999).size == 200 and serving.Scope(0).lookback_days == 1
    assert hash(scope) == hash(serving.Scope(90, ("EN", "FR"), ()))


def test_summary(spark):
    got = serving.summarize(rows(spark, story("a", score=64.0), story("b", score=81.0, source="B"), story("c", score=None))).first()
    assert tuple(got) == (3, 72.5, 81.0, 2)
    assert tuple(serving.summarize(rows(spark)).first()) == (0, 0.0, 0.0, 0)


def test_story_dedup(spark):
    df = rows(
        spark,
        story("a", "Big win for town | Site A"),
        story("b", "Big win, for town! 2026"),
        story("c", None, "https://x.com/a/?q=1"),
        story("d", None, "https://x.com/a"),
        story("e", "Été"),
    )
    assert sorted(r.article_id for r in serving.dedupe_stories(df, F.asc("article_id")).collect()) == ["a", "c", "e"]
    assert df.filter("article_id = 'e'").select(serving.story_title(F.col("title")).alias("t")).first().t == "été"


def test_row_operators(spark):
    df = rows(
        spark,
        story("a", score=80.0),
        story("b", score=70.0),
        story("c", score=60.0, eligible=False, reason="below_threshold", source="B"),
        story("d", score=70.0, day=4),
        story("e", score=None, eligible=False, reason="odd", source=None),
    )
    line = {str(r.serving_date): tuple(r)[1:] for r in serving.timeline(df).collect()}
    assert line == {"2026-04-01": (4, 2, 70.0), "2026-04-04": (1, 1, 70.0)}
    assert [tuple(r) for r in serving.source_rankings(df).collect()] == [("A", 3, 73.33)]
    dist = [r.story_count for r in serving.score_distribution(df).orderBy("bucket_order").collect()]
    assert dist == [1, 0, 2, 0, 1, 0]
    assert [r.story_count for r in serving.eligibility_breakdown(df).orderBy("bucket_order").collect()] == [3, 1, 0, 0, 0, 0]
    assert [r.article_id for r in serving.visible_stories(df.withColumn("title", F.col("article_id")), serving.MOST_RECENT, F.asc("article_id")).collect()] == ["d", "a", "b"]


def test_optional_columns(spark):
    df = rows(spark, story("a")).withColumn("tone_score", F.lit(1.0))
    got = serving.brief_rows(df, serving.Scope(30), serving.Page(), as_of=datetime(2026, 4, 5)).first()
    assert got.language is None and got.mentioned_country_name is None
    with pytest.raises(Exception, match="serving_date|UNRESOLVED"):
        serving.brief_rows(df.drop("serving_date"), serving.Scope(30), serving.Page(), as_of=datetime(2026, 4, 5))


def test_paging(spark):
    df = rows(spark, *(story(f"{k:02}") for k in range(11)))
    page, number, pages, total = serving.paginate(df, 9, 10, F.asc("article_id"))
    assert (number, pages, total, [r.article_id for r in page.collect()]) == (2, 2, 11, ["10"])
    assert serving.clamp_page(5, 100, 10, scope_changed=True) == 1
    with pytest.raises(ValueError):
        serving.total_pages(1, 0)


def test_facets():
    offered = {(): {"EN", "FR"}, ("X",): {"EN"}}
    scope = serving.Scope(7, ("EN", "FR"), ("X",))
    pruned = serving.resolve_facets(scope, lambda s: offered[s.geographies], lambda s: {"X"})
    assert pruned.languages == ("EN",) and pruned.geographies == ("X",)
    assert serving.resolve_facets(scope, lambda s: set(), lambda s: set(), preserve=True) == scope


def test_cache():
    now = [0.0]
    cache, made = serving.TimedCache(60, lambda: now[0]), []
    for t in (0.0, 59.0, 60.0):
        now[0] = t
        cache.get(serving.Scope(7), lambda: made.append(1))
    assert len(made) == 2


def test_safe_url(spark):
    df = spark.createDataFrame([(u,) for u in ("https://a.com/?a=1&b='<", "javascript:alert(1)", "http://", None)], "u string")
    assert [r.x for r in df.select(serving.safe_url(F.col("u")).alias("x")).collect()] == ["https://a.com/?a=1&amp;b=&#x27;&lt;", None, None, None]


def test_report(spark):
    metrics = spark.createDataFrame(
        [(datetime(2026, 4, 1, 9), datetime(2026, 4, 1, 8), 5, 5, 5, 0, 5, 70.0, 80.0)],
        "audit_run_at timestamp, latest_gold_ingested_at timestamp, bronze_row_count long, silver_row_count long, silver_canonical_row_count long, "
        "silver_duplicate_row_count long, gold_row_count long, gold_avg_happy_factor double, gold_max_happy_factor double",
    )
    df = rows(spark, story("a"), story("b", eligible=False, reason="x"), story("c", eligible=False, reason="x"), story("d", eligible=False, reason="y"))
    got = ops.daily_report(metrics, df, as_of=datetime(2026, 4, 1, 12)).first()
    assert (got.action_needed, got.eligible_row_count, got.ineligible_row_count, got.top_exclusions) == ("healthy", 1, 3, "x=2,y=1")
    assert ops.daily_report(metrics, df, as_of=datetime(2026, 4, 3)).first().action_needed == "gold_stale"
    assert ops.daily_report(metrics, df.filter("not is_positive_feed_eligible"), as_of=datetime(2026, 4, 1, 12)).first().action_needed == "eligible_feed_empty"
    assert ops.daily_report(metrics.withColumn("gold_row_count", F.lit(0)), df, as_of=datetime(2026, 4, 1, 12)).first().action_needed == "gold_empty"


def test_ranked_rows(spark):
    scores = [None, *(float(k % 17) for k in range(400))]
    df = rows(spark, *(story(f"a{k:03}", score=v, day=k % 28 + 1) for k, v in enumerate(scores))).repartition(7)
    for order in (serving.MOST_OPTIMISTIC, serving.LEAST_OPTIMISTIC, serving.MOST_RECENT, serving.OLDEST):
        want = [(k, r.article_id) for k, r in enumerate(serving.sort_rows(df, order).collect(), 1)]
        assert sorted((r.sort_rank, r.article_id) for r in serving.ranked_rows(df, order).collect()) == want
    assert serving.ranked_rows(df.limit(0), serving.OLDEST).count() == 0


def test_time_labels(spark):
    as_of = datetime(2026, 4, 12, 9)
    rows = [(datetime(2026, 4, 12, 1),), (datetime(2026, 4, 11, 23, 59),), (datetime(2026, 1, 2),), (datetime(2025, 12, 31, 5),), (None,)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = df.select(serving.relative_day(F.col("t"), as_of).alias("r"), serving.time_label(F.col("t")).alias("l")).collect()
    assert [r.r for r in got] == ["Today", "Yesterday", "Jan 2", "Dec 31, 2025", "Unknown"]
    assert [r.l for r in got] == ["Apr 12, 2026 (UTC)", "Apr 11, 2026 (UTC)", "Jan 2, 2026 (UTC)", "Dec 31, 2025 (UTC)", "Unknown"]


def test_page_columns_equal_page_functions(spark):
    cells = [(p, n, s) for p in range(-1, 13) for n in (0, 1, 10, 11, 95) for s in (1, 7, 10)]
    df = spark.createDataFrame(cells, "p long, n long, s long")
    current, pages = serving.page_columns(F.col("p"), F.col("n"), F.col("s"))
    assert [tuple(r) for r in df.select(current, pages).collect()] == [(serving.clamp_page(p, n, s), serving.total_pages(n, s)) for p, n, s in cells]
