"""Bronze-shaped input derived from the driver's tables, so that every model has data: one article row per event.

``k`` is the event's number, every fifth event repeating its predecessor's, so that there are duplicates; an article's url
comes from the page ``k`` modulo the pages, its language and source from the document ``k`` modulo the documents.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 2, 1)
HEADLINES = (
    "Community wins award", "Hostage rescued from fire", "Robert Lee obituary", "Fuel supply probe widens", "NASA BIG DATA NEWS HOUR",
    "WATCH live updates!!! photo gallery...", "Quiet harbour opens new library", "Peace talks bring relief effort", "Obituary fundraiser for town", "Free family fun day returns",
)
COUNTRIES = (("US", "United States"), ("FR", "France"), ("ES", "Spain"), ("DE", "Germany"), ("BR", "Brazil"), ("ZZ", "Unknown"))
#: By the article's number modulo 8; the last has no result.
URL_STATUSES = ("valid", "broken", "timeout", "forbidden", "redirect_loop", "unavailable", "valid", None)
URL_CODES = (200, 404, None, 403, 302, 503, 200, None)
MALFORMED_RATIO = 0.01


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _url_parts(url) -> tuple:
    """Of a page, not of each of the events that have it."""
    return F.regexp_replace(url, r"[?#].*\z", "").alias("page_stem"), F.regexp_extract(url, r"://([^/?#]+)", 1).alias("page_host")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, k, and what the row's page and document give."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    k = F.when((F.col("event_id") % 5 == 0) & (F.col("event_id") > 0), F.col("event_id") - 1).otherwise(F.col("event_id"))
    pages, docs = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"), *_url_parts(F.col("url"))), table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    sizes = pages.agg(F.count("*").alias("n_pages")).crossJoin(docs.agg(F.count("*").alias("n_docs")))  # one row
    rows = events.withColumn("k", k).crossJoin(F.broadcast(sizes)).withColumn("page_id", F.col("k") % F.col("n_pages")).withColumn("doc_id", F.col("k") % F.col("n_docs"))
    return rows.join(pages, "page_id", "left").join(docs, "doc_id", "left")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, c, e = articles(spark, sf_dir), F.col, F.col("event_id")
    tail = F.when(e % 2 == 0, F.lit("?utm=x")).otherwise(F.lit("/"))
    url = F.when(e % 40 == 7, F.lit(None)).when(e % 97 == 3, F.lit("not a url!!")).otherwise(F.concat("page_stem", F.lit("/"), c("k").cast("string"), tail))
    suffix = F.when(c("k") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), F.floor(c("k") / 7).cast("string")))
    run = F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd"))
    rows = rows.select(
        F.concat(F.lit("e"), e.cast("string")).alias("source_record_id"),
        run.alias("ingestion_id"),
        (c("ts") + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
        F.when(e % 50 != 0, c("ts")).alias("published_at"),
        c("source").alias("source_name"),
        F.when(e % 40 != 7, F.col("page_host")).alias("source_domain"),
        url.alias("source_url"),
        F.when(e % 33 != 1, F.concat(_pick(HEADLINES, c("k") % 10), suffix)).alias("title"),
        c("lang").alias("language"),
        F.lit("native").alias("language_resolution_status"),
        _pick([a for a, _ in COUNTRIES], c("k") % 6).alias("mentioned_country_code"),
        _pick([b for _, b in COUNTRIES], c("k") % 6).alias("mentioned_country_name"),
        F.when(c("k") % 6 == 5, "undetermined").otherwise("v2_locations").alias("mentioned_country_resolution_status"),
        (10 - F.floor("value") / 10).alias("tone_raw"),
    )
    accepted = F.when(F.col("ingestion_id") < "run_20240115", F.lit(None).cast("long"))
    payload = F.to_json(F.struct(F.lit(7).alias("bronze_run_accepted_row_count"), F.lit(MALFORMED_RATIO).alias("bronze_run_malformed_ratio")))
    return rows.withColumns({"bronze_run_accepted_row_count": accepted, "bronze_run_malformed_ratio": F.lit(None).cast("double"), "raw_payload": payload})


def url_results(silver: DataFrame) -> DataFrame:
    """A result for most normalised URLs of canonical rows."""
    number = F.expr("cast(substring(source_record_id, 2) as bigint)")
    rows = silver.filter("not is_duplicate and normalized_url is not null").groupBy("normalized_url").agg(F.min(number).alias("n"))
    picked = _pick(URL_STATUSES, F.col("n") % 8)
    checked = F.lit(AS_OF.isoformat(sep=" ")).cast(silver.schema["ingested_at"].dataType) - F.make_dt_interval(F.col("n").cast("int") % 40)
    return rows.withColumn("status", picked).filter("status is not null").select(
        "normalized_url",
        checked.alias("checked_at"),
        F.concat(F.lit("https://"), "normalized_url").alias("final_url"),
        _pick(URL_CODES, F.col("n") % 8).cast("long").alias("http_status_code"),
        (F.col("n") % 3).alias("redirect_count"),
        "status",
    )


def eval_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """include or exclude for articles whose document has a quality label."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = articles(spark, sf_dir).select("event_id", "doc_id").join(labels, "doc_id")
    label = F.when(F.col("quality") == 1, "include").otherwise("exclude")
    return rows.select(F.sha2(F.concat(F.lit("e"), F.col("event_id").cast("string")), 256).alias("article_id"), label.alias("default_feed_label"))


def metrics_history(silver: DataFrame, feed: DataFrame) -> DataFrame:
    """One metrics row per ingestion, as if each had been measured alone."""
    in_feed = feed.select("article_id", "happy_factor", F.lit(1).alias("in_feed"))
    rows = silver.select("article_id", "ingestion_id", "ingested_at", "published_at", "is_duplicate").join(in_feed, "article_id", "left")
    seen = F.when(F.col("in_feed") == 1, F.col("ingested_at"))
    return rows.groupBy("ingestion_id").agg(
        F.max("ingested_at").alias("audit_run_at"),
        F.count("*").alias("bronze_row_count"),
        F.count("*").alias("silver_row_count"),
        F.count_if(~F.col("is_duplicate")).alias("silver_canonical_row_count"),
        F.count_if("is_duplicate").alias("silver_duplicate_row_count"),
        F.count("in_feed").alias("gold_row_count"),
        F.round(F.avg("happy_factor"), 2).alias("gold_avg_happy_factor"),
        F.max("happy_factor").alias("gold_max_happy_factor"),
        F.max(seen).alias("latest_gold_ingested_at"),
    )


RAW_CODES = ("US", "FR", "DE", "BR", "XX")
TRANSLATIONS = ("source:foo;srclc:eng;", "srclc:fra", "", "srclc:zz_top;", "srclc:spa;eng:x", "srclc:pt", "srclc:de")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows (source_file, line, fields): one per event, some of them malformed."""
    rows, c, e = articles(spark, sf_dir), F.col, F.col("event_id")
    text = lambda value: F.lit(value)
    place = F.concat(text("1#Place#US#US##;4#Town#"), _pick(RAW_CODES, c("k") % 5), text("#;no-code;2#City# "), F.lower(_pick(RAW_CODES, (c("k") + 2) % 5)), text(" #"))
    fields = {
        0: F.when(e % 61 == 7, text("  ")).otherwise(F.concat(text("r"), e.cast("string"))),
        1: F.when(e % 20 == 3, text("0")).when(e % 53 == 5, text("not-a-time")).otherwise(F.date_format("ts", "yyyyMMddHHmmss")),
        2: F.when(e % 4 == 1, text("2")).otherwise(text(" 1 ")),
        3: F.concat(text("WWW."), "source", text(".Com ")),
        4: F.col("page_url"),
        10: F.when(e % 13 == 2, text("")).otherwise(place),
        15: F.when(e % 70 == 3, text("")).otherwise(F.concat(F.floor("value").cast("string"), text(",0.5,1"))),
        25: _pick(TRANSLATIONS, c("k") % 7),
        26: F.when(e % 9 == 4, text("")).otherwise(F.concat(text("<A>1</A><PAGE_TITLE> "), _pick(HEADLINES, c("k") % 10), text(" &amp; more </PAGE_TITLE>"))),
    }
    every = F.array(*(fields.get(k, text("")) for k in range(27)))
    made = F.when(e % 41 == 9, F.slice(every, 1, 26)).otherwise(every)
    # a generator's row is made once, as a file's is read once; as a plain expression it would be made anew for each use of a field
    return rows.select(F.concat(text("batch-"), F.date_format("ts", "yyyyMMdd")).alias("source_file"), e.alias("line"), F.explode(F.array(made)).alias("fields"))
