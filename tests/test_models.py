"""Models and formulas on small inputs."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from brightwire.functions import scoring, text
from brightwire.operators import feed, quality, rules, silver
from brightwire.plans import checks

AS_OF = datetime(2026, 4, 12)
BRONZE = (
    "source_record_id string, ingestion_id string, ingested_at timestamp, published_at timestamp, source_name string, source_domain string, language string, "
    "language_resolution_status string, mentioned_country_code string, mentioned_country_name string, mentioned_country_resolution_status string, "
    "source_url string, title string, tone_raw double"
)


def article(n, title="Neutral headline", tone=5.88, url=None, published=datetime(2026, 4, 10, 8), **other):
    row = {
        "source_record_id": f"r{n}", "ingestion_id": "run", "ingested_at": datetime(2026, 4, 10, 9), "published_at": published, "source_name": "A", "source_domain": "a.com", "language": "EN",
        "language_resolution_status": "native", "mentioned_country_code": "us", "mentioned_country_name": "United States", "mentioned_country_resolution_status": "v2_locations",
        "source_url": url or f"https://a.com/{n}", "title": title, "tone_raw": tone,
    }
    row |= other
    return tuple(row.values())


def refined(spark, *rows):
    return silver.refine(spark.createDataFrame(list(rows), BRONZE), as_of=AS_OF)


HEADLINES = [
    ("Neutral headline", 5.88, None),
    ("Cookie Foundation's FREE Easter Family Fun day brings community together", 5.0, None),
    ("International Business Senior Kenya executives quit over fuel supply probe", 5.88, "soft_deny_without_exception"),
    ('Robert "Bob" Emerson Lee Obit', 5.86, "hard_deny_term"),
    ("Four Israelis rescued from hostage situation", 5.5, None),
    ("Obituary fundraiser announced", 8.0, "hard_deny_term"),
    ("AVOID AREA Explosions Reported near highway", 5.55, "soft_deny_without_exception"),
    ("   ", 5.0, "missing_title"),
    ("Quiet day", 2.0, "below_threshold"),
]


def test_headlines(spark):
    rows = refined(spark, *(article(n, t, tone) for n, (t, tone, _) in enumerate(HEADLINES)))
    got = {r.source_record_id: r for r in feed.feed(rows, rules.guardrail_terms(spark), as_of=AS_OF).collect()}
    assert [got[f"r{n}"].exclusion_reason for n in range(len(HEADLINES))] == [r for _, _, r in HEADLINES]
    assert got["r0"].base_happy_factor == 79.4
    assert got["r1"].happy_factor > got["r1"].base_happy_factor
    assert got["r4"].allow_hit_count > 0 and got["r4"].soft_deny_hit_count > 0 and got["r4"].is_positive_feed_eligible
    assert got["r5"].allow_hit_count > 0 and got["r5"].hard_deny_hit_count > 0


def test_vocabulary():
    rows = rules.vocabulary_rows()
    kinds = [(k, s) for _, k, s, _, _ in rows]
    assert len(rows) == len({r[0] for r in rows}) == 110
    assert [kinds.count(k) for k in (("deny_hard", "token"), ("deny_soft", "token"), ("allow", "token"), ("allow", "phrase"))] == [18, 51, 31, 10]


def test_literal_hits_equal_joined_hits(spark):
    titles = [t for t, _, _ in HEADLINES] + ["Town saved bystander", "wins award wins award", None, "Peace talks; relief effort"]
    df = spark.createDataFrame([(f"r{n}", t) for n, t in enumerate(titles)], "source_record_id string, title string")
    terms = rules.guardrail_terms(spark)
    a, b = rules.with_hits(df, terms), rules.with_joined_hits(df, terms)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)
    twice = rules.with_hits(df, terms.unionAll(terms)).select("source_record_id", "allow_hit_count")
    once = dict(map(tuple, a.select("source_record_id", "allow_hit_count").collect()))
    assert all(n == 2 * once[k] for k, n in twice.collect())


def test_a_large_vocabulary(spark):
    import random

    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(400)]
    phrases = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(170_000)} | {"a", "ab", "abc", "", "Ab Cd"})
    kinds = list(rules.CLASSES)
    terms = [(p, kinds[k % 3], "phrase", True, "") for k, p in enumerate(phrases)] + [(w, "allow", "token", True, "") for w in words[:50]]
    titles = [" ".join(rng.choices(words, k=rng.randint(0, 9))).capitalize() for _ in range(120)] + [None, "", "xAB CDx", phrases[777] + "z", "z" + phrases[888]]
    df = spark.createDataFrame([(f"r{n}", t) for n, t in enumerate(titles)], "source_record_id string, title string")
    got = rules.with_hits(df, spark.createDataFrame(terms, rules.TERM_SCHEMA).repartition(4))
    assert len(phrases) > 100_000 and "NestedLoop" not in got._jdf.queryExecution().toString()
    by_id = {r.source_record_id: r for r in got.collect()}
    for n, title in enumerate(titles):
        text_form = "".join(c if c.isalnum() else " " for c in (title or "").lower())
        text_form = " ".join(text_form.split(" ")) if "  " not in text_form else text_form
        for kind, name in rules.CLASSES.items():
            want = {t for t, k, scope, _, _ in terms if k == kind and (t.lower() in text_form if scope == "phrase" else t in text_form.split())}
            assert by_id[f"r{n}"][f"{name}_terms"] == sorted(want), (title, kind)
    few = spark.createDataFrame([t for t in terms if rng.random() < 0.01] + [("ab", "allow", "phrase", True, "")], rules.TERM_SCHEMA)
    a, b = rules.with_hits(df, few), rules.with_joined_hits(df, few)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)
    none = rules.with_joined_hits(df, few.filter("match_scope = 'token'"))
    assert none.agg(F.sum("allow_phrase_hit_count")).first()[0] == 0


def test_silver_forms(spark):
    rows = refined(
        spark,
        article(1, "  Two\t words \n", url=" HTTPS://WWW.A.com/X/?q=1#f "),
        article(2, "two words", url="http://www.a.com/x", published=datetime(2026, 4, 10, 9)),
        article(3, "two words", source_url=None, published=None, source_domain=" ", language="", mentioned_country_code=None),
        article(4, "old", published=datetime(2025, 12, 1)),
    )
    got = {r.source_record_id: r for r in rows.collect()}
    assert set(got) == {"r1", "r2", "r3"}
    assert got["r1"].title == "Two words" and got["r1"].normalized_url == got["r2"].normalized_url == "www.a.com/x"
    assert got["r1"].is_duplicate and not got["r2"].is_duplicate
    assert all(r.is_near_duplicate_candidate for r in got.values())
    assert got["r3"].dedup_key == "title:two words|source:unknown-source|bucket:2026041009"
    assert (got["r3"].language, got["r3"].mentioned_country_code) == ("und", "ZZ")


def test_empty_silver(spark):
    assert refined(spark).collect() == []
    assert feed.feed(refined(spark), rules.guardrail_terms(spark), as_of=AS_OF).columns == feed.FEED_COLUMNS


def one(spark, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))


SOUND = {
    "has_title": True, "has_url": True, "has_valid_url": True, "hard_deny_hit_count": 0, "soft_deny_hit_count": 0, "allow_hit_count": 0, "url_quality_status": "valid",
    "positivity_score": 80.0, "suitability_score": 90.0, "headline_shape_penalty": 0.0, "url_quality_penalty": 0.0, "source_quality_adjustment": 0.0,
}


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"has_title": False, "has_url": False}, "missing_title"),
        ({"has_url": False, "has_valid_url": False}, "missing_url"),
        ({"has_valid_url": False, "hard_deny_hit_count": 1}, "malformed_url"),
        ({"hard_deny_hit_count": 1, "soft_deny_hit_count": 1}, "hard_deny_term"),
        ({"soft_deny_hit_count": 1, "url_quality_status": "broken"}, "soft_deny_without_exception"),
        ({"soft_deny_hit_count": 1, "allow_hit_count": 1, "url_quality_status": "broken"}, "url_broken"),
        ({"url_quality_status": "redirect_loop", "positivity_score": 1.0}, "url_redirect_loop"),
        ({"url_quality_status": "unavailable"}, "url_unavailable"),
        ({"positivity_score": 64.99, "suitability_score": 1.0}, "below_positivity_threshold"),
        ({"suitability_score": 59.99}, "low_suitability"),
    ],
)
def test_v3_ladder(spark, change, reason):
    row = one(spark, **(SOUND | change)).select(scoring.v3_reason().alias("r"), scoring.v3_reason(True).alias("g")).first()
    assert row.r == reason
    assert row.g == (reason if reason != "below_positivity_threshold" else "low_suitability")


def test_v3_formulas(spark):
    score = lambda **v: one(spark, **(SOUND | v)).select(scoring.suitability().alias("s")).first().s
    assert score() == 100.0
    assert score(hard_deny_hit_count=1) == 0.0
    assert score(soft_deny_hit_count=1) == 75.0
    assert score(source_quality_adjustment=99.0, url_quality_penalty=20.0) == 88.0
    assert score(source_quality_adjustment=-99.0) == 92.0
    base = lambda tone: spark.range(1).select(scoring.base_score(F.lit(tone)).alias("b")).first().b
    assert (base(-20.0), base(12.5), base(0.0)) == (0.0, 100.0, 50.0)
    assert spark.range(1).select(scoring.v3_score(F.lit(80.0), F.lit(60.0)).alias("h")).first().h == 74.0
    bait = {"has_punctuation_bait": True, "title_token_count": 6, "uppercase_ratio": 0.5, "has_gallery_bait": True, "template_repeat_count": 8}
    assert one(spark, **bait).select(scoring.headline_penalty().alias("p")).first().p == 20.0
    statuses = spark.createDataFrame([(s,) for s in ("broken", "valid", "odd", None)], "s string")
    assert [r.p for r in statuses.select(scoring.url_penalty(F.col("s")).alias("p")).collect()] == [40.0, 0.0, 0.0, 5.0]


def test_shadow_explains(spark):
    rows = refined(spark, article(1, "WATCH: BIG NEWS!!! photo gallery today"), article(2, "Town wins award", tone=8.0))
    terms = rules.guardrail_terms(spark)
    urls = spark.createDataFrame([("a.com/1", datetime(2026, 4, 11), "broken", 404)], "normalized_url string, checked_at timestamp, status string, http_status_code long")
    snapshot = quality.source_quality(rows, feed.feed(rows, terms, as_of=AS_OF), urls, as_of=AS_OF)
    got = {r.source_record_id: r for r in feed.shadow_feed(rows, terms, urls, snapshot, as_of=AS_OF).collect()}
    assert got["r1"].exclusion_reason == "url_broken" and got["r1"].url_quality_penalty == 40.0
    why = json.loads(got["r1"].score_explanation)
    assert set(why) == set(feed.EXPLAINED) and why["has_punctuation_bait"] and why["has_gallery_bait"] and why["allow_terms"] == []
    assert json.loads(got["r2"].score_explanation)["allow_terms"] == ["award", "wins", "wins award"]
    assert got["r2"].is_positive_feed_eligible and json.loads(got["r2"].score_explanation)["exclusion_reason"] is None


def test_accents_do_not_hide_capitals(spark):
    df = spark.createDataFrame([("ÉCOLE NASA ab X",)], "t string")
    assert df.select(text.uppercase_count(F.col("t")).alias("n")).first().n == 2


def test_checks_find_faults(spark):
    rows = refined(spark, article(1), article(2))
    got = {(r.column_name, r.check_name): r.failures for r in checks.column_checks(rows, checks.DECLARED["silver"]).collect()}
    assert set(got.values()) == {0}
    bad = rows.withColumn("article_id", F.lit("x")).withColumn("tone_score", F.lit(500.0))
    got = {(r.column_name, r.check_name): r.failures for r in checks.column_checks(bad, checks.DECLARED["silver"]).collect()}
    assert got[("article_id", "unique")] == 1 and got[("tone_score", "max")] == 2
    with pytest.raises(checks.ChecksFailed):
        checks.gate(checks.column_checks(bad, checks.DECLARED["silver"]))
    assert checks.freshness(rows, AS_OF, False).first().failures == 0
    assert checks.freshness(rows, datetime(2026, 5, 1), False).first().failures == 1
    assert checks.freshness(rows.limit(0), AS_OF, True).first().failures == 0


def test_history_checks(spark):
    metrics = "audit_run_at timestamp, gold_row_count long, silver_row_count long, silver_duplicate_row_count long, latest_gold_ingested_at timestamp"
    run = lambda day, gold, copies=10: (datetime(2026, 4, day), gold, 100, copies, datetime(2026, 4, day))
    alone = spark.createDataFrame([run(1, 5)], metrics)
    assert checks.row_drop(alone).first().failures == 0
    steady = spark.createDataFrame([run(d, 100) for d in range(1, 9)], metrics)
    dropped = steady.unionAll(spark.createDataFrame([run(9, 69, 40)], metrics))
    assert checks.row_drop(steady).first().failures == 0 and checks.duplicate_drift(steady).first().failures == 0
    assert checks.row_drop(dropped).first().failures == 1 and checks.duplicate_drift(dropped).first().failures == 1
    assert checks.metrics_freshness(dropped, datetime(2026, 4, 10)).first().failures == 0
    assert checks.metrics_freshness(dropped, datetime(2026, 4, 20)).first().failures == 1


KEYED = "article_id string, published_at timestamp, ingested_at timestamp, dedup_key string, normalized_title string, dedup_date date"


def keyed_rows(spark, n=3000):
    """A third of the rows share a title and a day, another third a dedup key; some have no title or time."""
    day, times = datetime(2026, 4, 10), [None, *(datetime(2026, 4, 10, h) for h in range(5))]
    rows = [(f"{k * 7919 % 10007:05}", times[k % 6], day, f"url:{k}" if k % 3 else "url:hot", None if k % 11 == 5 else "hot" if k % 3 == 1 else f"t{k % 200}", day.date()) for k in range(n)]
    return spark.createDataFrame(rows, KEYED)


def by_windows(keyed):
    from pyspark.sql import Window

    first = Window.partitionBy("dedup_key").orderBy(F.desc_nulls_last("published_at"), F.desc("ingested_at"), F.desc("article_id"))
    same = Window.partitionBy("normalized_title", "dedup_date")
    return keyed.select("article_id", (F.row_number().over(first) > 1).alias("d"), F.when(F.col("normalized_title").isNull(), 1).otherwise(F.count("*").over(same)).cast("long").alias("n"))


@pytest.mark.parametrize("large", [100_000, 500, 3])
def test_duplicates_without_windows(spark, monkeypatch, large):
    from brightwire.operators import groups

    monkeypatch.setattr(groups, "LARGE", large)
    keyed = keyed_rows(spark)
    got = keyed.transform(silver.with_duplicates).transform(silver.with_title_counts)
    assert sorted(map(tuple, got.select("article_id", "is_duplicate", "normalized_title_day_count").collect())) == sorted(map(tuple, by_windows(keyed).collect()))
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    ranks = {r.article_id: r.dedup_rank for r in keyed.transform(silver.with_ranks).collect()}
    assert {r.article_id for r in got.collect() if r.is_duplicate} == {a for a, k in ranks.items() if k > 1}


def test_a_common_title_and_key_fill_no_task(spark, monkeypatch):
    from brightwire.operators import groups

    monkeypatch.setattr(groups, "LARGE", 100)
    for k, v in {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "12", "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(k, v)
    try:
        for step in (silver.with_duplicates, silver.with_title_counts):
            out = keyed_rows(spark).repartition(6).transform(step)
            used = F.max(F.xxhash64("*")).alias("used")  # else the joins, which add no rows, are left out
            sizes = sorted(r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), used).collect())
            assert len(sizes) == 12 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_silver_of_a_repeated_record(spark):
    rows = refined(spark, article(1), article(1), article(2, url="https://a.com/1", published=datetime(2026, 4, 9)))
    assert sorted((r.source_record_id, r.is_duplicate) for r in rows.collect()) == [("r1", False), ("r1", False), ("r2", True)]
