"""Plans that stay in proportion at size: what is made once a row, and what stays small."""

from pyspark.sql import functions as F

import __spark_entry__
from brightwire.functions import text
from brightwire.operators import feed, rules, silver
from brightwire.plans import checks, queries
from brightwire.session import METHOD_BYTES
from brightwire.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_raw_rows_are_made_once_and_methods_stay_compilable(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    df = __spark_entry__.queries()["ext_lang_resolve"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("slice(") == 1 and plan.count("Generate explode") == 1
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == METHOD_BYTES
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "4000")  # a session's own smaller limit stays
    __spark_entry__.queries()["ext_lang_resolve"](spark, SF)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "4000"
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    assert fixtures.raw(spark, SF).count() == fixtures.table(spark, SF, "events").count()


def test_silver_makes_bronze_once(spark):
    bronze = fixtures.bronze(spark, SF)
    refined = silver.refine(bronze, as_of=fixtures.AS_OF)
    plan = refined._jdf.queryExecution().optimizedPlan().toString()
    assert refined.inputFiles() and all("/cleaned-" in str(f) for f in refined.inputFiles()) and "events.parquet" not in plan
    read = [line.split("[", 1)[1] for line in plan.splitlines() if "Relation" in line]
    assert read and not any("article_id" in line or "dedup_key" in line for line in read)  # made of what was read
    assert refined.count() == bronze.count()


def test_unique_values_are_shuffled_without_other_checks(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), (None, 300), ("b", -200)], "id string, n long")
    found = checks.column_checks(rows, {"id": {"not_null": True, "unique": True}, "n": {"not_null": True, "min": -100, "max": 100}})
    assert sorted(map(tuple, found.collect())) == [("id", "not_null", 1), ("id", "unique", 1), ("n", "max", 1), ("n", "min", 1), ("n", "not_null", 1)]
    assert [tuple(r) for r in checks.column_checks(rows, {"id": {"unique": True}}).collect()] == [("id", "unique", 1)]
    by_id = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "HashAggregate(keys=[id" in line]
    assert by_id and not any("if (" in line for line in by_id)  # conditional counts
    assert "metrics" not in queries._reads("chk_column") and "metrics" in queries._reads("chk_custom")


def test_plain_texts_need_no_patterns(spark):
    rows = spark.createDataFrame([("t", "u", 1.0)], "title string, url string, tone_score double")
    cleaned = rows.select(text.filled(F.col("url")), text.collapse(F.col("title")), text.normal_url(F.col("url")), text.is_blank(F.col("title")))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert "^\\s+" not in plan and "^https?://" not in plan and plan.lower().count("contains(") >= 7  # what is left of patterns is behind a plain search
    hits = rules.with_hits(rows, rules.guardrail_terms(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in hits and "instr(" not in hits and "INSET" in hits
    stages = feed.with_urls(rows.withColumn("normalized_url", text.normal_url(F.col("url"))), spark.createDataFrame([], "normalized_url string, status string, checked_at timestamp, http_status_code long"))
    assert "_own_hash" in stages._jdf.queryExecution().optimizedPlan().toString()


def test_text_columns_mean_what_their_patterns_mean(spark):
    texts = (None, "", " \t\n\x0b\f\r", " a  b\tc\u00a0", "https://http://A.b/?x#y", "http://a/b\n?c\n#d", "HTTP://a//", "/", "a#b?c", "NASA bcD", "X\u212a \u0130Q", "a\u00e9AB_CD EF")
    c, rows = F.col("s"), spark.createDataFrame([(s,) for s in texts], "s string")
    strip = F.regexp_replace(c, r"^\s+|\s+\z", "")
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(c), r"^https?://", ""), r"(?d)[?#].*\z", ""), r"/\z", "")
    pairs = [
        (text.strip(c), strip),
        (text.collapse(c), F.nullif(F.regexp_replace(strip, r"\s+", " "), F.lit(""))),
        (text.normal_url(c), F.nullif(url, F.lit(""))),
        (text.uppercase_count(c), text.count_matches(c, "(?<![A-Za-z0-9_])[A-Z]{2,}(?![A-Za-z0-9_])")),
        (text.token_count(c, text.tokens(c)), text.count_matches(c, "[A-Za-z0-9]+")),
    ]
    for row in rows.select("s", *(a.eqNullSafe(b).alias(f"same{k}") for k, (a, b) in enumerate(pairs))).collect():
        assert all(row[1:]), row
