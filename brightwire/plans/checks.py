"""Data-quality checks: declared column checks, and the fifteen custom ones. A check gives 0 where it passes.

Every table is read once for its declared checks and once for its custom ones: a check is an aggregate column, and all of a
table's checks are one row, turned into rows afterwards. Values that must be unique are counted by a scan of their own column,
so that only they are shuffled, without a buffer of every other check beside each value.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwire.functions.text import VALID_URL
from brightwire.functions.times import instant
from brightwire.operators.quality import latest_runs

FRESH_HOURS, HISTORY_RUNS = 48, 8
ROW_DROP, DUPLICATE_DRIFT, MALFORMED = 0.7, 0.1, 0.02
BAD_REASONS = ("missing_url", "malformed_url", "url_broken", "url_redirect_loop", "url_unavailable")

#: table: column: its checks. "unique" and "not_null" stand alone, bounds with their value.
DECLARED: dict[str, dict[str, dict[str, float | bool]]] = {
    "bronze": {
        **dict.fromkeys(("ingestion_id", "ingested_at", "language", "language_resolution_status", "mentioned_country_code", "mentioned_country_name", "mentioned_country_resolution_status"), {"not_null": True}),
        "source_record_id": {"not_null": True, "unique": True},
    },
    "url_results": {"normalized_url": {"not_null": True, "unique": True}, **dict.fromkeys(("checked_at", "redirect_count", "status"), {"not_null": True})},
    "silver": {
        **dict.fromkeys(("source_record_id", "ingestion_id", "ingested_at", "language_resolution_status", "mentioned_country_code", "mentioned_country_name", "mentioned_country_resolution_status", "dedup_key", "is_duplicate", "is_near_duplicate_candidate"), {"not_null": True}),
        "article_id": {"unique": True, "not_null": True},
        "tone_score": {"min": -100, "max": 100},
    },
    "terms": dict.fromkeys(("term", "rule_class", "match_scope", "is_active"), {"not_null": True}),
    "feed": {
        **dict.fromkeys(("source_record_id", "serving_date", "happy_factor_version", "is_positive_feed_eligible", "positive_guardrail_version", "ingested_at"), {"not_null": True}),
        "article_id": {"unique": True, "not_null": True},
        "base_happy_factor": {"not_null": True, "min": 0, "max": 100},
        "happy_factor": {"not_null": True, "min": 0, "max": 100},
        **dict.fromkeys(("allow_hit_count", "soft_deny_hit_count", "hard_deny_hit_count"), {"not_null": True, "min": 0}),
    },
    "source_quality": {"source_domain": {"not_null": True, "unique": True}, **dict.fromkeys(("sample_row_count", "source_quality_tier", "source_quality_adjustment", "snapshot_window_start", "snapshot_window_end", "computed_at"), {"not_null": True})},
    "shadow": {
        **dict.fromkeys(("source_record_id", "serving_date", "language", "language_resolution_status", "mentioned_country_code", "mentioned_country_name", "mentioned_country_resolution_status"), {"not_null": True}),
        "article_id": {"unique": True, "not_null": True},
        **dict.fromkeys(("base_happy_factor", "positivity_score", "suitability_score", "happy_factor"), {"not_null": True, "min": 0, "max": 100}),
        **dict.fromkeys(("happy_factor_version", "is_positive_feed_eligible", "positive_guardrail_version", "allow_hit_count", "soft_deny_hit_count", "hard_deny_hit_count"), {"not_null": True}),
        **dict.fromkeys(("url_quality_status", "url_quality_penalty", "headline_shape_penalty", "source_quality_adjustment", "ingested_at"), {"not_null": True}),
    },
    "metrics": dict.fromkeys(
        ("audit_run_at", "bronze_row_count", "silver_row_count", "silver_canonical_row_count", "silver_duplicate_row_count", "latest_bronze_ingestion_accepted_row_count", "latest_bronze_ingestion_malformed_ratio", "gold_row_count"), {"not_null": True}
    ),
    "labels": {"article_id": {"not_null": True, "unique": True}},
}


def column_checks(df: DataFrame, declared: dict[str, dict]) -> DataFrame:
    """(column_name, check_name, failures): a table's checks in one pass, and a scan of the column alone for each that is to be unique."""
    cells: list[tuple[str, str, Column]] = []
    for name, checks in declared.items():
        c = F.col(name)
        for check, value in checks.items():
            failures = {
                "not_null": lambda c=c, v=value: F.count_if(c.isNull()),
                "unique": lambda c=c, v=value: F.count(c) - F.count_distinct(c),
                "min": lambda c=c, v=value: F.count_if(c < v),
                "max": lambda c=c, v=value: F.count_if(c > v),
            }[check]()
            cells.append((name, check, failures))
    made = [f.cast("long").alias(f"c{k}") for k, (_, _, f) in enumerate(cells)]
    alone = [df.agg(made[k]) for k, (_, check, _) in enumerate(cells) if check == "unique"]
    plain = [made[k] for k, (_, check, _) in enumerate(cells) if check != "unique"]
    wide = reduce(DataFrame.crossJoin, ([df.agg(*plain)] if plain else []) + alone)  # one row each
    long = [F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("check_name"), F.col(f"c{i}").alias("failures")) for i, (n, k, _) in enumerate(cells)]
    return wide.select(F.inline(F.array(*long)))


def _fails_unless(holds: Column) -> Column:
    """0 or 1; an unknown condition fails."""
    return F.when(holds, 0).otherwise(1)


def _one(df: DataFrame, failures: Column) -> DataFrame:
    return df.agg(failures.cast("long").alias("failures"))


def _fresh(df: DataFrame, as_of: datetime, empty_passes: bool, column: str = "ingested_at") -> Column:
    fresh = F.max(column) >= instant(as_of - timedelta(hours=FRESH_HOURS), df, column)
    return _fails_unless((F.count("*") == 0) | fresh if empty_passes else fresh)


def freshness(df: DataFrame, as_of: datetime, empty_passes: bool, column: str = "ingested_at") -> DataFrame:
    return _one(df, _fresh(df, as_of, empty_passes, column))


def _eligible_with(holds: Column) -> Column:
    return F.count_if(F.col("is_positive_feed_eligible") & holds)


def _out_of_bounds(column: str, low: float, high: float) -> Column:
    return F.count_if((F.col(column) < low) | (F.col(column) > high))


def _newest(value) -> Column:
    return F.max(F.when(F.col("run_rank") == 1, F.col(value) if isinstance(value, str) else value))


def _against_history(value, holds) -> Column:
    """Over the last runs with their rank; 0 while there is no history."""
    before = F.avg(F.when(F.col("run_rank").between(2, HISTORY_RUNS), F.col(value) if isinstance(value, str) else value))
    return _fails_unless(before.isNull() | holds(_newest(value), before))


def ranked(df: DataFrame, *order: Column, n: int = HISTORY_RUNS) -> DataFrame:
    """The newest ``n`` runs and their rank: a top-n first, so one task numbers n rows at most."""
    return df.orderBy(*order).limit(n).withColumn("run_rank", F.row_number().over(Window.orderBy(*order)))


def _row_drop() -> Column:
    return _against_history("gold_row_count", lambda now, before: now >= ROW_DROP * before)


def _duplicate_drift() -> Column:
    ratio = F.try_divide(F.col("silver_duplicate_row_count").cast("double"), F.col("silver_row_count"))
    return _against_history(ratio, lambda now, before: F.abs(now - before) <= DUPLICATE_DRIFT)


def _metrics_fresh(metrics: DataFrame, as_of: datetime) -> Column:
    limit = instant(as_of - timedelta(hours=FRESH_HOURS), metrics, "latest_gold_ingested_at")
    return _fails_unless((_newest("gold_row_count") == 0) | (_newest("latest_gold_ingested_at") >= limit))


def row_drop(metrics: DataFrame) -> DataFrame:
    return _one(ranked(metrics, F.desc("audit_run_at")), _row_drop())


def duplicate_drift(metrics: DataFrame) -> DataFrame:
    return _one(ranked(metrics, F.desc("audit_run_at")), _duplicate_drift())


def metrics_freshness(metrics: DataFrame, as_of: datetime) -> DataFrame:
    return _one(ranked(metrics, F.desc("audit_run_at")), _metrics_fresh(metrics, as_of))


def custom_checks(bronze: DataFrame, silver: DataFrame, feed: DataFrame, shadow: DataFrame, source_quality: DataFrame, metrics: DataFrame, *, as_of: datetime) -> list[tuple[DataFrame, dict[str, Column]]]:
    """The fifteen checks: each table (or its newest runs) with its checks by name, as aggregates over it."""
    c = F.col
    hard = c("hard_deny_hit_count") > 0
    runs = ranked(latest_runs(bronze, HISTORY_RUNS), F.desc("latest_ingested_at"), F.desc("ingestion_id"))
    return [
        (silver, {"silver_url_shape": F.count_if(c("normalized_url").isNotNull() & ~c("normalized_url").rlike(VALID_URL)), "silver_fresh": _fresh(silver, as_of, False)}),
        (feed, {"feed_fresh": _fresh(feed, as_of, True), "feed_no_hard_deny": _eligible_with(hard), "feed_no_soft_deny": _eligible_with((c("soft_deny_hit_count") > 0) & (c("allow_hit_count") == 0))}),
        (
            shadow,
            {
                "shadow_positivity_bounds": _out_of_bounds("positivity_score", 0, 100),
                "shadow_suitability_bounds": _out_of_bounds("suitability_score", 0, 100),
                "shadow_no_hard_deny": _eligible_with(hard),
                "shadow_no_bad_url": _eligible_with(F.coalesce(c("exclusion_reason").isin(*BAD_REASONS), F.lit(False))),
            },
        ),
        (source_quality, {"source_adjustment_bounds": _out_of_bounds("source_quality_adjustment", -8, 8)}),
        (ranked(metrics, F.desc("audit_run_at")), {"metrics_row_drop": _row_drop(), "metrics_duplicate_drift": _duplicate_drift(), "metrics_fresh": _metrics_fresh(metrics, as_of)}),
        # by the payload alone, of the newest run
        (runs, {"metrics_accepted_drop": _against_history("accepted_row_count", lambda now, before: now >= ROW_DROP * before), "metrics_malformed_ratio": _fails_unless(_newest("payload_malformed_ratio") <= MALFORMED)}),
    ]


def report(checks: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """(check_name, failures) of all checks: one aggregate a table."""

    def rows(df: DataFrame, own: dict[str, Column]) -> DataFrame:
        wide = df.agg(*(failures.cast("long").alias(name) for name, failures in own.items()))
        return wide.select(F.inline(F.array(*(F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failures")) for name in own))))

    return reduce(DataFrame.unionByName, (rows(df, own) for df, own in checks))


class ChecksFailed(RuntimeError):
    """Some check of a gate found failures."""


def gate(results: DataFrame) -> None:
    """Raise if any check failed."""
    if found := results.filter("failures > 0 or failures is null").collect():
        raise ChecksFailed(", ".join(str(r.asDict()) for r in found))
