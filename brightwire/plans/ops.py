"""Operations: comparing two feeds, sampling for review, the daily report, archiving, a whole run of the models."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightwire.functions.text import is_blank
from brightwire.functions.times import day, instant
from brightwire.operators.quality import share
from brightwire.sources.store import Table, export, exported_count, older_than

# Fixed values.
TOP, CHANGED = 10, 20
ARCHIVE_DAYS, DELETE_CAP = 45, 20_000
STALE_HOURS, TOP_EXCLUSIONS = 18, 3
WEAK_ROWS, WEAK_RATE = 5, 0.35
#: Hex digits by which rows are counted before a sample of them is sorted.
SLOT = 3
SUSPICIOUS_HOST = r"^https?://(127\.|10\.|192\.168\.|169\.254\.|metadata(\.|/|:)|metadata\.google\.internal)"
SUSPICIOUS_ADDRESS = r"^https?://[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"


# Comparing the canonical feed with the one beside it.


def _both(current: DataFrame, shadow: DataFrame) -> DataFrame:
    now = current.select("article_id", "title", F.col("happy_factor").alias("current_happy_factor"), F.col("is_positive_feed_eligible").alias("a"), F.col("exclusion_reason").alias("current_exclusion_reason"))
    then = shadow.select("article_id", "positivity_score", "suitability_score", F.col("happy_factor").alias("shadow_happy_factor"), F.col("is_positive_feed_eligible").alias("b"), F.col("exclusion_reason").alias("shadow_exclusion_reason"))
    return now.join(then, "article_id")


def overlap(current: DataFrame, shadow: DataFrame) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    counts = {"current_eligible_count": a, "shadow_eligible_count": b, "eligible_overlap_count": a & b, "newly_excluded_count": a & ~b, "newly_included_count": ~a & b}
    return _both(current, shadow).agg(*(F.count_if(c).alias(n) for n, c in counts.items()))


def _top(df: DataFrame, key: Column, name: str, count: str, limit: int | None) -> DataFrame:
    found = df.groupBy(key.alias(name)).agg(F.count("*").alias(count))
    return found if limit is None else found.orderBy(F.desc(count), name).limit(limit)


def exclusions(feed: DataFrame, limit: int | None = TOP) -> DataFrame:
    return _top(feed, F.coalesce("exclusion_reason", F.lit("eligible")), "bucket", "row_count", limit)


def changed_rows(current: DataFrame, shadow: DataFrame, silver: DataFrame, kind: str, limit: int = CHANGED) -> DataFrame:
    """kind: newly_included or newly_excluded; the highest new scores first."""
    if kind not in ("newly_included", "newly_excluded"):
        raise ValueError("kind is newly_included or newly_excluded")
    changed = _both(current, shadow).filter(~F.col("a") & F.col("b") if kind == "newly_included" else F.col("a") & ~F.col("b"))
    changed = changed.orderBy(F.desc("shadow_happy_factor"), F.desc("article_id")).limit(limit)  # article_id is unique, so the sources can come after
    return changed.join(silver.filter(~F.col("is_duplicate")).select("article_id", "source_domain"), "article_id", "left").select(
        "article_id", "source_domain", "title", "current_happy_factor", "shadow_happy_factor", "positivity_score", "suitability_score", "current_exclusion_reason", "shadow_exclusion_reason"
    )


def domain_mix(feed: DataFrame, silver: DataFrame, limit: int = TOP) -> DataFrame:
    rows = feed.filter("is_positive_feed_eligible").select("article_id").join(silver.select("article_id", "source_domain"), "article_id", "left")
    return _top(rows, F.coalesce("source_domain", F.lit("unknown-source")), "source_domain", "eligible_rows", limit)


def link_mix(shadow: DataFrame, limit: int = TOP) -> DataFrame:
    return _top(shadow.filter("is_positive_feed_eligible"), F.coalesce("url_quality_status", F.lit("unknown")), "url_quality_status", "eligible_rows", limit)


def label_precision(feed: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.filter(F.col("default_feed_label").isin("include", "exclude")).select("article_id", "default_feed_label")
    rows = feed.filter("is_positive_feed_eligible").select("article_id").join(known, "article_id")
    hits = F.count_if(F.col("default_feed_label") == "include")
    precision = F.round(F.try_divide(hits.cast("double"), F.count("*")), 4)
    return rows.agg(F.count("*").alias("labeled_eligible_rows"), hits.alias("labeled_include_hits"), precision.alias("include_precision"))


def compare(current: DataFrame, shadow: DataFrame, silver: DataFrame, labels: DataFrame | None = None) -> dict[str, DataFrame]:
    """All ten comparisons; without labels, the precisions are left out."""
    found = {
        "overlap": overlap(current, shadow),
        "current_exclusions": exclusions(current),
        "shadow_exclusions": exclusions(shadow),
        "newly_included": changed_rows(current, shadow, silver, "newly_included"),
        "newly_excluded": changed_rows(current, shadow, silver, "newly_excluded"),
        "current_domains": domain_mix(current, silver),
        "shadow_domains": domain_mix(shadow, silver),
        "shadow_links": link_mix(shadow),
    }
    if labels is not None:
        found |= {"current_precision": label_precision(current, labels), "shadow_precision": label_precision(shadow, labels)}
    return found


def compare_summary(overlap_row, current: float | None, shadow: float | None) -> str:
    counts = " ".join(f"{k}={v}" for k, v in overlap_row.asDict().items())
    return f"{counts} current_precision={current if current is not None else 'none'} shadow_precision={shadow if shadow is not None else 'none'}"


# A stratified sample for review.


def with_domains(feed: DataFrame, silver: DataFrame, *, as_of: datetime, days: int) -> DataFrame:
    rows = feed.filter(F.col("serving_date") >= day(as_of, days)).join(silver.select("article_id", F.col("source_domain").alias("_domain")), "article_id", "left")
    return rows.withColumn("source_domain", F.coalesce("_domain", F.lit("unknown-source"))).drop("_domain")


def weak_domains(rows: DataFrame) -> DataFrame:
    """source_domain, row_count, eligible_rate of the domains with enough rows, few of them eligible."""
    rates = rows.groupBy("source_domain").agg(F.count("*").alias("row_count"), share(F.col("is_positive_feed_eligible")).alias("rate"))
    return rates.filter((F.col("row_count") >= WEAK_ROWS) & (F.col("rate") < WEAK_RATE)).select("source_domain", "row_count", F.round("rate", 4).alias("eligible_rate"))


def sample_buckets(feed: DataFrame, silver: DataFrame, *, as_of: datetime, days: int) -> DataFrame:
    rows = with_domains(feed, silver, as_of=as_of, days=days)
    rows = rows.join(weak_domains(rows).select("source_domain", F.lit(True).alias("weak")), "source_domain", "left")
    c, reason = F.col, F.col("exclusion_reason")
    bucket = (
        F.when(c("is_positive_feed_eligible") & c("weak"), "eligible_weak_domain")
        .when(is_blank(c("title")) | is_blank(c("url")), "missing_required")
        .when(reason.isin("hard_deny_term", "soft_deny_without_exception", "below_threshold"), reason)
        .when(c("happy_factor").between(60, 75), "borderline_60_75")
        .when(c("is_positive_feed_eligible"), "eligible_current")
    )
    return rows.withColumn("benchmark_bucket", bucket).filter("benchmark_bucket is not null")


def bottom(rows: DataFrame, stratum: str, order: Column, k: int, rank: str) -> DataFrame:
    """The ``k`` rows of each stratum with the least ``order`` (hex digits of a hash), numbered by ``rank`` from 1.

    Rows are counted by stratum and first ``SLOT`` digits, which merges as any count does; the slot in which a stratum's k-th
    row lies bounds what is sorted, some k rows and a slot's worth of each stratum, never all rows.
    """
    rows = rows.withColumn("_order", order).withColumn("_slot", F.substring("_order", 1, SLOT))
    counts = rows.groupBy(stratum, "_slot").agg(F.count("*").alias("_n"))  # 16 ** SLOT rows a stratum at most
    upto = F.sum("_n").over(Window.partitionBy(stratum).orderBy("_slot"))
    last = counts.withColumn("_before", upto - F.col("_n")).filter(F.col("_before") < k).groupBy(stratum).agg(F.max("_slot").alias("_last"))
    near = rows.join(F.broadcast(last.withColumnRenamed(stratum, "_stratum")), (F.col(stratum) == F.col("_stratum")) & (F.col("_slot") <= F.col("_last")))
    ranked = near.withColumn(rank, F.row_number().over(Window.partitionBy(stratum).orderBy("_order")).cast("long"))
    return ranked.filter(F.col(rank) <= k).drop("_order", "_slot", "_stratum", "_last")


def review_sample(feed: DataFrame, silver: DataFrame, *, as_of: datetime, days: int = 30, bucket_size: int = 20, seed: int | None = None) -> DataFrame:
    """Up to ``bucket_size`` rows of each of the few buckets, by a hash of article_id, with ``seed`` if given: the same rows each time."""
    order = F.sha2("article_id" if seed is None else F.concat(F.lit(f"{seed}:"), "article_id"), 256)
    rows = bottom(sample_buckets(feed, silver, as_of=as_of, days=days), "benchmark_bucket", order, bucket_size, "bucket_rank")
    return rows.select("benchmark_bucket", "bucket_rank", "article_id", "source_record_id", "source_name", "source_domain", "serving_date", "happy_factor", "is_positive_feed_eligible", "exclusion_reason", "title", "url")


# The daily report.


def daily_report(metrics: DataFrame, feed: DataFrame, *, as_of: datetime) -> DataFrame:
    """One row: the newest run's figures, eligibility, the three most frequent exclusions, what needs doing."""
    counts = exclusions(feed, None)
    ranked = F.slice(F.array_sort(F.collect_list(F.when(F.col("bucket") != "eligible", F.struct((-F.col("row_count")).alias("n"), "bucket")))), 1, TOP_EXCLUSIONS)
    totals = counts.agg(
        F.coalesce(F.sum(F.when(F.col("bucket") == "eligible", F.col("row_count"))), F.lit(0)).alias("eligible_row_count"),
        F.coalesce(F.sum(F.when(F.col("bucket") != "eligible", F.col("row_count"))), F.lit(0)).alias("ineligible_row_count"),
        F.array_join(F.transform(ranked, lambda x: F.concat(x["bucket"], F.lit("="), (-x["n"]).cast("string"))), ",").alias("top_exclusions"),
    )
    latest = metrics.orderBy(F.desc("audit_run_at")).limit(1).crossJoin(totals)  # one row each
    seen = F.col("latest_gold_ingested_at")
    action = (
        F.when(F.coalesce("gold_row_count", F.lit(0)) <= 0, "gold_empty")
        .when(F.col("eligible_row_count") <= 0, "eligible_feed_empty")
        .when(seen.isNull() | (seen < instant(as_of - timedelta(hours=STALE_HOURS), metrics, "latest_gold_ingested_at")), "gold_stale")
        .otherwise("healthy")
    )
    names = "audit_run_at latest_gold_ingested_at bronze_row_count silver_row_count silver_canonical_row_count silver_duplicate_row_count gold_row_count gold_avg_happy_factor gold_max_happy_factor".split()
    return latest.select(*names, "eligible_row_count", "ineligible_row_count", "top_exclusions", action.alias("action_needed"))


def suspicious_urls(silver: DataFrame) -> DataFrame:
    """Canonical rows whose url looks like an internal address."""
    low = F.lower("url")
    return silver.filter(~F.col("is_duplicate") & (low.rlike(SUSPICIOUS_HOST) | low.rlike(SUSPICIOUS_ADDRESS))).select("article_id", "normalized_url", "url")


# Archiving old bronze rows: counted, exported, checked, deleted.


@dataclass
class ArchiveSummary:
    status: str
    phase_completed: str
    cutoff: datetime
    archive_path: str
    candidate_row_count: int = 0
    exported_row_count: int | None = None
    deleted_row_count: int | None = None
    remaining_eligible_row_count: int | None = None
    dry_run: bool = False
    delete_after_export: bool = False
    backlog_detected: bool = False
    error: str | None = None

    def line(self) -> str:
        return " ".join(f"{k}={'none' if v is None else v}" for k, v in asdict(self).items())


def archive_cutoff(started: datetime, days: int = ARCHIVE_DAYS, run_date: date | None = None, cutoff: datetime | None = None) -> datetime:
    """Midnight of the run's day, ``days`` before; or the given one."""
    return cutoff if cutoff is not None else datetime.combine(run_date or started.date(), time.min) - timedelta(days=days)


def archive_path(prefix: str, cutoff: datetime) -> str:
    if not re.match(r"^[a-z0-9]+://|^/", prefix):
        raise ValueError("the archive's prefix is a full path")
    return f"{prefix.rstrip('/')}/bronze/cutoff_date={cutoff.date().isoformat()}"


def archive(spark: SparkSession, bronze: Table, prefix: str, *, started: datetime, days: int = ARCHIVE_DAYS, delete: bool = False, dry_run: bool = False, cap: int = DELETE_CAP, cutoff: datetime | None = None, export_rows: Callable[[DataFrame, str], None] = export) -> ArchiveSummary:
    """Rows older than the cutoff to Parquet, and, if asked for, out of the table once the counts agree."""
    at = archive_cutoff(started, days, cutoff=cutoff)
    path, moment = archive_path(prefix, at), at.isoformat(sep=" ")
    old = older_than(bronze.read(), moment)
    out = ArchiveSummary("ok", "counted", at, path, old.count(), dry_run=dry_run, delete_after_export=delete)
    out.backlog_detected = out.candidate_row_count > cap
    if dry_run or not out.candidate_row_count:
        return out
    export_rows(old, path)
    out.phase_completed, out.exported_row_count = "exported", exported_count(spark, path)
    if out.exported_row_count != out.candidate_row_count:
        out.status, out.error = "failed", "exported rows differ from candidate rows"
        return out
    if not delete:
        return out
    if out.backlog_detected:
        out.status, out.error = "failed", "more rows than one run may delete"
        return out
    out.deleted_row_count = bronze.delete_before("ingested_at", moment) if "ingested_at" in bronze.stats else bronze.delete(f"ingested_at < cast('{moment}' as {bronze.schema['ingested_at'].dataType.simpleString()})")
    out.remaining_eligible_row_count = older_than(bronze.read(), moment).count()
    out.phase_completed = "deleted"
    if out.deleted_row_count != out.exported_row_count or out.remaining_eligible_row_count:
        out.status, out.error = "failed", "deleted rows differ from exported rows"
    return out


def reset(tables: list[Table], drop: Callable[[], object] = lambda: None) -> None:
    for table in tables:
        table.truncate()
    drop()
