"""Metrics and pulse kept by day: mergeable parts, of which a run makes those of its own days only.

A part is a row of counts, sums and extremes of one day's rows of one layer with equal (eligible, reason, bucket); parts of
different days merge to the same figures that a scan of all rows gives. Scores have two decimals, so their sums are exact as
decimals whatever the order is (a mean halfway between two hundredths may be rounded otherwise than a mean of doubles). ``Parts`` keeps them in a table; ``refresh`` reads only the partitions of the days it is told.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwire.functions.times import instant
from brightwire.operators.quality import payload
from brightwire.plans.serving import bucket_of, pulse_of
from brightwire.sources.store import Table

KEY = ("layer", "day", "ingestion_id", "eligible", "reason", "label", "place")
FIGURES = {
    "row_count": ("long", F.sum),
    "duplicates": ("long", F.sum),
    "accepted_column": ("long", F.max),
    "accepted_payload": ("long", F.max),
    "malformed_column": ("double", F.max),
    "malformed_payload": ("double", F.max),
    "happy_sum": ("decimal(38,2)", F.sum),
    "happy_min": ("double", F.min),
    "happy_max": ("double", F.max),
    "latest_ingested": ("timestamp", F.max),
    "latest_published": ("timestamp", F.max),
}
_KEY_TYPES = {"layer": "string", "day": "date", "ingestion_id": "string", "eligible": "boolean", "reason": "string", "label": "string", "place": "int"}


def _rows(df: DataFrame, layer: str, times: str) -> DataFrame:
    kinds = _KEY_TYPES | {name: kind for name, (kind, _) in FIGURES.items()} | {"latest_ingested": times, "latest_published": times}
    have = {"layer": F.lit(layer)} | {c: F.col(c) for c in df.columns}
    return df.select(*(have.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()))


def _times(df: DataFrame) -> str:
    return df.schema["ingested_at"].dataType.simpleString()


def bronze_parts(bronze: DataFrame) -> DataFrame:
    """By run, which lands on one day or some."""
    runs = bronze.groupBy(F.to_date("ingested_at").alias("day"), "ingestion_id").agg(
        F.count("*").alias("row_count"), F.max("ingested_at").alias("latest_ingested"),
        F.max("bronze_run_accepted_row_count").alias("accepted_column"), F.max(payload("bronze_run_accepted_row_count", "long")).alias("accepted_payload"),
        F.max("bronze_run_malformed_ratio").alias("malformed_column"), F.max(payload("bronze_run_malformed_ratio", "double")).alias("malformed_payload"),
    )
    return _rows(runs, "bronze", _times(bronze))


def silver_parts(silver: DataFrame) -> DataFrame:
    found = silver.groupBy(F.to_date("ingested_at").alias("day")).agg(F.count("*").alias("row_count"), F.count_if("is_duplicate").alias("duplicates"))
    return _rows(found, "silver", _times(silver))


def feed_parts(feed: DataFrame) -> DataFrame:
    label, place = bucket_of(F.col("happy_factor"))
    happy = F.col("happy_factor")
    keys = [F.col("serving_date").alias("day"), F.col("is_positive_feed_eligible").alias("eligible"), F.col("exclusion_reason").alias("reason"), label.alias("label"), place.alias("place")]
    found = feed.groupBy(*keys).agg(
        F.count("*").alias("row_count"), F.sum(happy.cast("decimal(20,2)")).alias("happy_sum"), F.min(happy).alias("happy_min"), F.max(happy).alias("happy_max"),
        F.max("ingested_at").alias("latest_ingested"), F.max("published_at").alias("latest_published"),
    )
    return _rows(found, "feed", _times(feed))


MAKERS = {"bronze": bronze_parts, "silver": silver_parts, "feed": feed_parts}
#: The columns of a layer that its parts are made of.
READS = {
    "bronze": ("ingested_at", "ingestion_id", "bronze_run_accepted_row_count", "bronze_run_malformed_ratio", "raw_payload"),
    "silver": ("ingested_at", "is_duplicate"),
    "feed": ("serving_date", "is_positive_feed_eligible", "exclusion_reason", "happy_factor", "ingested_at", "published_at"),
}
#: The column by whose days a layer's table is laid out.
DAY_OF = {"bronze": "ingested_at", "silver": "ingested_at", "feed": "serving_date"}


class Parts:
    def __init__(self, spark: SparkSession, path: str, times: str):
        self.spark, self.path, self.times = spark, path, times
        self._tables: dict[str, Table] = {}

    def table(self, layer: str) -> Table:
        if layer not in self._tables:
            schema = _rows(self.spark.range(0), layer, self.times).schema
            self._tables[layer] = Table(self.spark, f"{self.path}/{layer}", schema, sort_by=("day",))
        return self._tables[layer]

    def refresh(self, layer: str, source: Table, first: date, last: date) -> DataFrame:
        """Make the parts of the days from ``first`` to ``last`` anew; the rows that are read for it."""
        end = datetime.combine(last, datetime.max.time()) if DAY_OF[layer] == "ingested_at" else last
        rows = source.read(DAY_OF[layer], datetime.combine(first, datetime.min.time()) if DAY_OF[layer] == "ingested_at" else first, end)
        self.table(layer).replace_range("day", first, last, MAKERS[layer](rows))
        return rows

    def read(self, layer: str) -> DataFrame:
        return self.table(layer).read()


def merged(parts: DataFrame, *by: str) -> DataFrame:
    """Parts with equal ``by`` as one."""
    return parts.groupBy(*by).agg(*(how(name).alias(name) for name, (_, how) in FIGURES.items()))


def run_metrics(parts: Parts, *, as_of: datetime) -> DataFrame:
    """The run's metrics row from parts alone."""
    bronze, silver, feed = parts.read("bronze"), merged(parts.read("silver")), merged(parts.read("feed"))
    latest = merged(bronze, "ingestion_id").orderBy(F.desc("latest_ingested"), F.desc("ingestion_id")).limit(1)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    total = merged(bronze).select(zero("row_count").alias("bronze_row_count"))
    in_silver = silver.select(
        zero("row_count").alias("silver_row_count"), (zero("row_count") - zero("duplicates")).alias("silver_canonical_row_count"), zero("duplicates").alias("silver_duplicate_row_count")
    )
    run = latest.select(
        F.coalesce("accepted_column", "accepted_payload", "row_count").alias("latest_bronze_ingestion_accepted_row_count"),
        F.coalesce("malformed_column", "malformed_payload", F.lit(0.0)).alias("latest_bronze_ingestion_malformed_ratio"),
    )
    in_feed = feed.select(
        zero("row_count").alias("gold_row_count"), F.col("happy_min").alias("gold_min_happy_factor"), F.round(F.try_divide(F.col("happy_sum").cast("double"), F.col("row_count")), 2).alias("gold_avg_happy_factor"),
        F.col("happy_max").alias("gold_max_happy_factor"), F.col("latest_ingested").alias("latest_gold_ingested_at"), F.col("latest_published").alias("latest_gold_published_at"),
    )
    rows = total.crossJoin(in_silver).crossJoin(run).crossJoin(in_feed)  # one row each
    at = instant(as_of, bronze, "latest_ingested")
    return rows.select(at.alias("audit_run_at"), "*")


def pulse(parts: Parts) -> DataFrame:
    """section, bucket, row_count, bucket_order from the feed's parts."""
    counts = merged(parts.read("feed"), "eligible", "reason", "label", "place").select("eligible", "reason", "label", "place", F.col("row_count").alias("n"))
    return pulse_of(counts)
