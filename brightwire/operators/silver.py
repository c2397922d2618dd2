"""Bronze to silver: cleaning, normal forms, deterministic dedup.

A row is compared with others of its dedup key and of its title and day by what those have in common (``groups.beside``),
so neither a frequent key nor a title that a third of all rows share fills a task. A record that bronze holds twice outright,
which its key rules out, is no duplicate of itself.

Three plans read a row (two aggregates and the row itself), so ``refine`` writes what is costly to make, cleaned fields and
normal URLs, once; what follows from them at little cost isn't written, and no digest of an id is shuffled with a row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightwire.functions.text import collapse, filled, normal_url
from brightwire.functions.times import instant, seen_at
from brightwire.operators.groups import beside
from brightwire.sources.store import DENSE, cut

RETENTION_DAYS = 90
COLUMNS = (
    "source_record_id article_id ingestion_id ingested_at published_at source_name source_domain language language_resolution_status "
    "mentioned_country_code mentioned_country_name mentioned_country_resolution_status title normalized_title url normalized_url tone_score "
    "positive_signal_score negative_signal_score dedup_key is_duplicate is_near_duplicate_candidate"
).split()


def clean(bronze: DataFrame) -> DataFrame:
    """Stripped fields with their sentinels; title collapsed."""
    c = F.col
    filled_or = lambda x, other: F.coalesce(filled(x), F.lit(other))
    return bronze.select(
        "source_record_id",
        "ingestion_id",
        "ingested_at",
        "published_at",
        filled(c("source_name")).alias("source_name"),
        filled_or(c("source_domain"), "unknown-source").alias("source_domain"),
        filled_or(F.lower("language"), "und").alias("language"),
        filled_or(c("language_resolution_status"), "undetermined").alias("language_resolution_status"),
        filled_or(F.upper("mentioned_country_code"), "ZZ").alias("mentioned_country_code"),
        filled_or(c("mentioned_country_name"), "Unknown").alias("mentioned_country_name"),
        filled_or(c("mentioned_country_resolution_status"), "undetermined").alias("mentioned_country_resolution_status"),
        filled(c("source_url")).alias("url"),
        collapse(c("title")).alias("title"),
        c("tone_raw").cast("double").alias("tone_score"),
    )


def normalize(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumn("normalized_url", normal_url(F.col("url"))).withColumns(_titles() | _signals() | {"article_id": F.sha2("source_record_id", 256)})


def _titles() -> dict:
    return {"normalized_title": F.lower("title")}


def _signals() -> dict:
    none = F.lit(None).cast("double")
    return {"positive_signal_score": none, "negative_signal_score": none}


def key(normalized: DataFrame) -> DataFrame:
    bucket = F.date_format(seen_at(), "yyyyMMddHH")
    by_title = F.concat(
        F.lit("title:"), F.coalesce("normalized_title", F.lit("")), F.lit("|source:"), F.coalesce("source_domain", "source_name", F.lit("")), F.lit("|bucket:"), bucket
    )
    by_url = F.concat(F.lit("url:"), "normalized_url")
    return normalized.withColumn("dedup_key", F.when(F.col("normalized_url").isNotNull(), by_url).otherwise(by_title)).withColumn("dedup_date", F.to_date(seen_at()))


def _order(identity="article_id") -> list:
    return ["published_at", "ingested_at", identity]


def with_duplicates(keyed: DataFrame, identity="article_id", deal: str = "article_id") -> DataFrame:
    """``is_duplicate``: another row of the same key comes before it. The first of a key is a maximum, so no key is sorted. ``identity`` settles equal times."""
    first = F.struct(*_order(identity))
    rows = beside(keyed, F.col("dedup_key"), deal, _first=F.max(first))
    return rows.withColumn("is_duplicate", F.coalesce(first < F.col("_first"), F.lit(False))).drop("_first")


def with_title_counts(keyed: DataFrame, deal: str = "article_id") -> DataFrame:
    """``normalized_title_day_count``: rows with the same title on the same day; null titles are near duplicates of nothing."""
    title = F.concat(F.col("dedup_date").cast("string"), F.lit(" "), F.col("normalized_title"))
    rows = beside(keyed, title, deal, _titles=F.count("*"))
    rows = rows.withColumn("normalized_title_day_count", F.coalesce("_titles", F.lit(1).cast("long"))).drop("_titles")
    return rows.withColumn("is_near_duplicate_candidate", F.col("normalized_title_day_count") > 1)


def with_ranks(keyed: DataFrame) -> DataFrame:
    """``dedup_rank``: the place of each row among those of its key. Only where ranks are asked for: this sorts every key."""
    first = Window.partitionBy("dedup_key").orderBy(*(F.desc_nulls_last(c) for c in _order()))
    return keyed.withColumn("dedup_rank", F.row_number().over(first))


def retain(ranked: DataFrame, as_of: datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """After the comparisons: rows that are too old still count in them."""
    return ranked.filter(seen_at() >= instant(as_of, ranked, "ingested_at") - F.expr(f"INTERVAL {days} DAYS"))


def refine(bronze: DataFrame, *, as_of: datetime) -> DataFrame:
    made = cut(bronze.transform(clean).withColumn("normalized_url", normal_url(F.col("url"))), "cleaned", **DENSE)
    digest = F.unhex(F.sha2("source_record_id", 256)).alias("digest")  # bytes are in the order of the id's letters
    rows = made.withColumns(_titles()).transform(key).transform(with_duplicates, digest, "source_record_id").transform(with_title_counts, "source_record_id").transform(retain, as_of)
    return rows.withColumns(_signals() | {"article_id": F.sha2("source_record_id", 256)}).select(*COLUMNS)
