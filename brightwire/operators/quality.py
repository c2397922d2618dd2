"""Source quality, and the metrics of a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwire.functions.scoring import BAD_URL, quality_tier, tier_adjustment
from brightwire.functions.times import day, instant, seen_at
from brightwire.operators.groups import with_found

WINDOW_DAYS = 30


def share(holds: Column) -> Column:
    """Of rows; a null condition counts as false."""
    return F.avg(F.when(holds, 1.0).otherwise(0.0))


def _domain() -> Column:
    return F.coalesce("source_domain", F.lit("unknown-source")).alias("source_domain")


def eligibility_by_source(feed: DataFrame, silver: DataFrame, as_of: datetime) -> DataFrame:
    own = silver.filter(~F.col("is_duplicate")).select("article_id", _domain())
    recent = feed.filter(F.col("serving_date") >= day(as_of, WINDOW_DAYS)).select("article_id", "is_positive_feed_eligible", "exclusion_reason")
    return recent.join(own, "article_id").groupBy("source_domain").agg(
        F.count("*").alias("sample_row_count"),
        share(F.col("is_positive_feed_eligible")).alias("eligible_rate"),
        share(F.col("exclusion_reason") == "hard_deny_term").alias("hard_exclusion_rate"),
        share(F.col("exclusion_reason") == "soft_deny_without_exception").alias("soft_exclusion_rate"),
    )


def urls_by_source(silver: DataFrame, url_results: DataFrame, as_of: datetime) -> DataFrame:
    recent = silver.filter(~F.col("is_duplicate") & (F.to_date(seen_at()) >= day(as_of, WINDOW_DAYS))).select(_domain(), "normalized_url")
    joined = with_found(recent, url_results.select("normalized_url", "status"), "normalized_url")
    return joined.groupBy("source_domain").agg(share(F.coalesce("status", F.lit("unchecked")).isin(*BAD_URL)).alias("invalid_or_unavailable_url_rate"))


def copies_by_source(silver: DataFrame, as_of: datetime) -> DataFrame:
    recent = silver.filter(F.to_date(seen_at()) >= day(as_of, WINDOW_DAYS))
    return recent.groupBy(_domain()).agg(share(F.col("is_duplicate") | F.col("is_near_duplicate_candidate")).alias("duplicate_or_near_duplicate_rate"))


def source_quality(silver: DataFrame, feed: DataFrame, url_results: DataFrame, *, as_of: datetime) -> DataFrame:
    """One row per source of the last 30 days, with its tier and adjustment."""
    rows = eligibility_by_source(feed, silver, as_of).join(urls_by_source(silver, url_results, as_of), "source_domain", "left").join(copies_by_source(silver, as_of), "source_domain", "left")
    rates = ("eligible_rate", "hard_exclusion_rate", "soft_exclusion_rate", "invalid_or_unavailable_url_rate", "duplicate_or_near_duplicate_rate")
    rows = rows.withColumns({c: F.round(F.coalesce(c, F.lit(0.0)), 4) for c in rates}).withColumn("source_quality_tier", quality_tier())
    return rows.select(
        "source_domain",
        "sample_row_count",
        *rates,
        "source_quality_tier",
        tier_adjustment(F.col("source_quality_tier")).alias("source_quality_adjustment"),
        day(as_of, WINDOW_DAYS).alias("snapshot_window_start"),
        day(as_of).alias("snapshot_window_end"),
        instant(as_of, silver, "ingested_at").alias("computed_at"),
    )


def payload(field: str, kind: str) -> Column:
    return F.get_json_object("raw_payload", f"$.{field}").try_cast(kind)


def run_counts(bronze: DataFrame) -> DataFrame:
    """One row per ingestion: accepted rows by column, else by payload, else by count."""
    accepted = F.coalesce(F.max("bronze_run_accepted_row_count"), F.max(payload("bronze_run_accepted_row_count", "long")), F.count("*"))
    malformed = F.coalesce(F.max("bronze_run_malformed_ratio"), F.max(payload("bronze_run_malformed_ratio", "double")), F.lit(0.0))
    return bronze.groupBy("ingestion_id").agg(
        F.count("*").alias("row_count"),
        accepted.alias("accepted_row_count"),
        malformed.alias("malformed_ratio"),
        F.coalesce(F.max(payload("bronze_run_malformed_ratio", "double")), F.lit(0.0)).alias("payload_malformed_ratio"),
        F.max("ingested_at").alias("latest_ingested_at"),
    )


def latest_runs(bronze: DataFrame, n: int) -> DataFrame:
    return run_counts(bronze).orderBy(F.desc("latest_ingested_at"), F.desc("ingestion_id")).limit(n)


def latest_run(bronze: DataFrame) -> DataFrame:
    return latest_runs(bronze, 1).select(
        F.col("accepted_row_count").alias("latest_bronze_ingestion_accepted_row_count"), F.col("malformed_ratio").alias("latest_bronze_ingestion_malformed_ratio")
    )


def run_metrics(bronze: DataFrame, silver: DataFrame, feed: DataFrame, *, as_of: datetime) -> DataFrame:
    """One row: the four one-row aggregates side by side."""
    in_silver = silver.agg(
        F.count("*").alias("silver_row_count"), F.count_if(~F.col("is_duplicate")).alias("silver_canonical_row_count"), F.count_if("is_duplicate").alias("silver_duplicate_row_count")
    )
    in_feed = feed.agg(
        F.count("*").alias("gold_row_count"),
        F.min("happy_factor").alias("gold_min_happy_factor"),
        F.round(F.avg("happy_factor"), 2).alias("gold_avg_happy_factor"),
        F.max("happy_factor").alias("gold_max_happy_factor"),
        F.max("ingested_at").alias("latest_gold_ingested_at"),
        F.max("published_at").alias("latest_gold_published_at"),
    )
    total = bronze.agg(F.count("*").alias("bronze_row_count"))
    rows = total.crossJoin(in_silver).crossJoin(latest_run(bronze)).crossJoin(in_feed)  # one row each
    return rows.select(instant(as_of, bronze, "ingested_at").alias("audit_run_at"), "*")
