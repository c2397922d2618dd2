"""Run guards: a run that read too little, or too much that is malformed, stops before it lands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
MAX_MALFORMED_RATIO, MIN_ACCEPTED_RATIO, BASELINE_RUNS = 0.05, 0.50, 5


class RunRejected(RuntimeError):
    """The run failed one of its guards."""


def recent_runs(bronze: DataFrame, n: int = BASELINE_RUNS) -> DataFrame:
    """ingestion_id, accepted_row_count, latest_ingested_at of the newest runs."""
    runs = bronze.groupBy("ingestion_id").agg(F.count("*").alias("accepted_row_count"), F.max("ingested_at").alias("latest_ingested_at"))
    return runs.orderBy(F.desc("latest_ingested_at"), F.desc("ingestion_id")).limit(n)


def guard_failure(total: int, accepted: int, malformed: int, recent: Sequence[int], max_malformed: float = MAX_MALFORMED_RATIO, min_accepted: float = MIN_ACCEPTED_RATIO) -> str | None:
    if total == 0:
        return "the files hold no rows"
    if accepted == 0:
        return "no row passed containment"
    if malformed / total > max_malformed:
        return f"malformed row ratio {malformed / total:.2%} is over {max_malformed:.2%}"
    if recent and accepted < min_accepted * sum(recent) / len(recent):
        return f"accepted row count {accepted} is below {min_accepted:.0%} of the recent average {sum(recent) / len(recent):.1f}"
    return None


def enforce(stats: DataFrame, bronze: DataFrame | None, batches: int, n: int = BASELINE_RUNS) -> None:
    """Raise RunRejected; a run that found no batch file isn't judged. ``stats`` is the one row of run_stats."""
    if not batches:
        return
    row = stats.first()
    recent = [r.accepted_row_count for r in recent_runs(bronze, n).collect()] if bronze is not None else []
    if failure := guard_failure(row.bronze_run_total_row_count, row.bronze_run_accepted_row_count, row.bronze_run_malformed_row_count, recent):
        raise RunRejected(failure)


def guard_verdict(stats: DataFrame, recent: DataFrame, max_malformed: float = MAX_MALFORMED_RATIO, min_accepted: float = MIN_ACCEPTED_RATIO) -> DataFrame:
    """The same as one row of columns: the statistics, the baseline and the failure (null if none)."""
    base = recent.agg(F.avg("accepted_row_count").alias("recent_average"))
    total, accepted, malformed = (F.col(f"bronze_run_{k}_row_count") for k in ("total", "accepted", "malformed"))
    failure = (
        F.when(total == 0, "no_rows")
        .when(accepted == 0, "none_accepted")
        .when(malformed / total > max_malformed, "malformed_ratio")
        .when(accepted < min_accepted * F.col("recent_average"), "accepted_collapse")
    )
    return stats.crossJoin(base).withColumn("failure", failure)  # one row each
