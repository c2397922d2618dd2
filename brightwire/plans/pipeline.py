"""The models in their order, each written once and read by all that depend on it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from brightwire.operators import feed, quality, rules, silver, url_health
from brightwire.plans import checks
from brightwire.sources.store import Table

#: Layout: the timestamp or date by whose days a table is partitioned, and the order within a day (so that statistics prune).
LAYOUT = {
    "silver": {"day_of": "ingested_at", "sort_by": ("dedup_key", "source_domain", "language")},
    "terms": {},
    "feed": {"partition_by": ("serving_date",), "sort_by": ("source_name",)},
    "shadow": {"partition_by": ("serving_date",), "sort_by": ("source_name", "source_domain")},
    "url_results": {"sort_by": ("normalized_url",)},
    "source_quality": {},
    "metrics": {"day_of": "audit_run_at"},
}


def build(spark: SparkSession, bronze: DataFrame, warehouse: str, *, as_of: datetime, opener: url_health.Opener | None = None, check: bool = True, labels: DataFrame | None = None) -> dict[str, DataFrame]:
    """Silver, terms, feed, URL results, source quality, the dual-score feed and the run's metrics; then the checks.

    URL results read silver, so they come after it. ``labels``, made elsewhere, are checked too if given.
    """
    made: dict[str, DataFrame] = {}

    def table(name: str, schema) -> Table:
        return Table(spark, f"{warehouse}/{name}", schema, **LAYOUT[name])

    def replace(name: str, df: DataFrame) -> DataFrame:
        own = table(name, df.schema)
        own.replace(df)
        made[name] = own.read()
        return made[name]

    refined = replace("silver", silver.refine(bronze, as_of=as_of))
    terms = replace("terms", rules.guardrail_terms(spark))
    current = replace("feed", feed.feed(refined, terms, as_of=as_of))
    results = table("url_results", url_health.RESULT_SCHEMA)
    due = url_health.due_candidates(refined, results.read(), as_of=as_of)
    results.upsert(url_health.check_urls(due, as_of=as_of, opener=opener), ["normalized_url"], ["checked_at"])
    made["url_results"] = results.read()
    snapshot = replace("source_quality", quality.source_quality(refined, current, made["url_results"], as_of=as_of))
    shadow = replace("shadow", feed.shadow_feed(refined, terms, made["url_results"], snapshot, as_of=as_of))
    row = quality.run_metrics(bronze, refined, current, as_of=as_of)
    metrics = table("metrics", row.schema)
    metrics.append(row)
    made["metrics"] = metrics.read()
    if check:
        checks.gate(checks.report(checks.custom_checks(bronze, refined, current, shadow, snapshot, made["metrics"], as_of=as_of)))
        for name, declared in checks.DECLARED.items():
            if (rows := {"labels": labels, "bronze": bronze}[name] if name in ("labels", "bronze") else made[name]) is not None:
                checks.gate(checks.column_checks(rows, declared))
    return made
