"""The serving queries: feed, brief page, summary, facets, status, pulse; and the row operators behind the page.

A configuration is a frozen dataclass, so it is also the key of a cache. Optional columns that a table lacks are nulls.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Hashable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwire.functions.text import filled, strip
from brightwire.functions.times import day, seen_at
from brightwire.operators.feed import FEED_COLUMNS
from brightwire.sources.store import cut

# Columns, sort orders, buckets and labels of the serving layer.
OPTIONAL = ("language", "language_resolution_status", "mentioned_country_code", "mentioned_country_name", "mentioned_country_resolution_status")
BRIEF_COLUMNS = "article_id serving_date published_at source_name language mentioned_country_name title url tone_score happy_factor ingested_at".split()
MOST_OPTIMISTIC, LEAST_OPTIMISTIC, MOST_RECENT, OLDEST = "Most optimistic first", "Least optimistic first", "Most recent news", "Oldest news"
BUCKETS = (("Below 65", None, 65.0), ("65-70", 65.0, 70.0), ("70-75", 70.0, 75.0), ("75-80", 75.0, 80.0), ("80-85", 80.0, 85.0), ("85+", 85.0, None))
REASONS = {
    "eligible": "Eligible", "below_threshold": "Below Threshold", "hard_deny_term": "Hard Deny Term", "soft_deny_without_exception": "Soft Deny Without Exception",
    "missing_title": "Missing Title", "missing_url": "Missing URL",
}
MAX_LOOKBACK, MAX_ROWS, RECENT_RUNS, TOP_SOURCES = 30, 200, 12, 8
STAGES = (
    ("Bronze Landed", "bronze_row_count"), ("Silver Normalized", "silver_row_count"), ("Silver Canonical", "silver_canonical_row_count"),
    ("Gold Scored", "gold_row_count"), ("Gold Eligible", "eligible_row_count"),
)


def bounded(n: int, low: int, high: int) -> int:
    return max(low, min(int(n), high))


def normal_values(values) -> tuple[str, ...]:
    return tuple(sorted({str(v).strip() for v in values} - {""}))


@dataclass(frozen=True)
class Scope:
    """What a reader has selected."""

    lookback_days: int = 7
    languages: tuple[str, ...] = ()
    geographies: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "lookback_days", bounded(self.lookback_days, 1, MAX_LOOKBACK))
        object.__setattr__(self, "languages", normal_values(self.languages))
        object.__setattr__(self, "geographies", normal_values(self.geographies))


@dataclass(frozen=True)
class Page:
    number: int = 1
    size: int = 10
    order: str = MOST_OPTIMISTIC

    def __post_init__(self) -> None:
        object.__setattr__(self, "number", max(1, int(self.number)))
        object.__setattr__(self, "size", bounded(self.size, 1, MAX_ROWS))
        object.__setattr__(self, "order", self.order if self.order in (MOST_OPTIMISTIC, LEAST_OPTIMISTIC) else MOST_OPTIMISTIC)

    @property
    def offset(self) -> int:
        return (self.number - 1) * self.size


def available(df: DataFrame, names) -> DataFrame:
    """The columns, optional ones as nulls where the table lacks them; others that it lacks are an error."""
    return df.select(*(F.lit(None).cast("string").alias(c) if c in OPTIONAL and c not in df.columns else F.col(c) for c in names))


def in_scope(feed: DataFrame, scope: Scope, as_of: datetime) -> DataFrame:
    lacking = {c: F.lit(None).cast("string") for c in OPTIONAL if c not in feed.columns}
    rows = feed.withColumns(lacking) if lacking else feed
    rows = rows.filter((F.col("serving_date") >= day(as_of, scope.lookback_days)) & F.col("is_positive_feed_eligible"))
    if scope.languages:
        rows = rows.filter(F.upper(strip(F.col("language"))).isin(*scope.languages))
    if scope.geographies:
        rows = rows.filter(strip(F.col("mentioned_country_name")).isin(*scope.geographies))
    return rows


def _order(happy: Column) -> list[Column]:
    return [happy, seen_at().desc(), F.desc("article_id")]


def feed_rows(feed: DataFrame, *, as_of: datetime, lookback_days: int = 7, limit: int = MAX_ROWS) -> DataFrame:
    rows = in_scope(feed, Scope(lookback_days), as_of).orderBy(*_order(F.asc("happy_factor"))).limit(bounded(limit, 1, MAX_ROWS))
    return available(rows, FEED_COLUMNS)


def brief_rows(feed: DataFrame, scope: Scope, page: Page, *, as_of: datetime) -> DataFrame:
    happy = F.asc("happy_factor") if page.order == LEAST_OPTIMISTIC else F.desc("happy_factor")
    return available(in_scope(feed, scope, as_of).orderBy(*_order(happy)).offset(page.offset).limit(page.size), BRIEF_COLUMNS)


def brief_rows_of(rows: DataFrame, page: Page) -> DataFrame:
    """A page's worth of the first rows."""
    happy = F.asc("happy_factor") if page.order == LEAST_OPTIMISTIC else F.desc("happy_factor")
    return available(rows.orderBy(*_order(happy)).limit(page.size), BRIEF_COLUMNS)


@dataclass(frozen=True)
class Seek:
    """The place of a row in the brief's order: what the next page begins behind."""

    happy_factor: float
    seen_at: datetime
    article_id: str


def brief_after(feed: DataFrame, scope: Scope, after: Seek | None, size: int = 10, order: str = MOST_OPTIMISTIC, *, as_of: datetime) -> DataFrame:
    """The page behind ``after``, the first one without it. Rows of earlier pages are filtered in the scan, however many they are, and never sorted."""
    page, rows = Page(1, size, order), in_scope(feed, scope, as_of)
    if after is not None:
        happy, seen = F.col("happy_factor"), seen_at()
        at, kind = F.lit(after.seen_at), feed.schema["ingested_at"].dataType
        later = (happy > after.happy_factor) if page.order == LEAST_OPTIMISTIC else (happy < after.happy_factor)
        bound = (happy >= after.happy_factor) if page.order == LEAST_OPTIMISTIC else (happy <= after.happy_factor)
        tied = (seen < at.cast(kind)) | ((seen == at.cast(kind)) & (F.col("article_id") < after.article_id))
        rows = rows.filter(bound).filter(later | tied)
    return brief_rows_of(rows, page)


def page_ends(feed: DataFrame, scope: Scope, size: int = 10, order: str = MOST_OPTIMISTIC, *, as_of: datetime) -> DataFrame:
    """page and the place (happy_factor, seen_at, article_id) of its last row, of every page: what ``brief_after`` needs to open any page directly."""
    rows = in_scope(feed, scope, as_of).select("happy_factor", seen_at().alias("seen_at"), "article_id")
    happy = F.asc("happy_factor") if order == LEAST_OPTIMISTIC else F.desc("happy_factor")
    ranked = numbered(rows, [happy, F.desc("seen_at"), F.desc("article_id")], "place").filter(F.col("place") % size == 0)
    return ranked.select((F.col("place") / size).cast("long").alias("page"), "happy_factor", "seen_at", "article_id")


def scope_summary(feed: DataFrame, scope: Scope, *, as_of: datetime) -> DataFrame:
    return in_scope(feed, scope, as_of).agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.round(F.avg("happy_factor"), 2), F.lit(0.0)).alias("avg_happy_factor"),
        F.coalesce(F.round(F.max("happy_factor"), 2), F.lit(0.0)).alias("max_happy_factor"),
        F.count_distinct(filled(F.col("source_name"))).alias("source_count"),
    )


def language_options(feed: DataFrame, scope: Scope, *, as_of: datetime) -> DataFrame:
    """Languages within the selected geographies; the selected languages don't narrow it."""
    rows = in_scope(feed, Scope(scope.lookback_days, (), scope.geographies), as_of)
    return rows.select(F.upper(strip(F.col("language"))).alias("language")).filter("language is not null and language not in ('', 'UND')").distinct().orderBy("language")


def geography_options(feed: DataFrame, scope: Scope, *, as_of: datetime) -> DataFrame:
    rows = in_scope(feed, Scope(scope.lookback_days, scope.languages, ()), as_of)
    rows = rows.select(strip(F.col("mentioned_country_name")).alias("geography"))
    return rows.filter("geography is not null and geography != '' and lower(geography) != 'unknown'").distinct().orderBy("geography")


def status(metrics: DataFrame) -> DataFrame:
    """The newest metrics row."""
    return metrics.orderBy(F.desc("audit_run_at")).limit(1)


def recent_metrics(metrics: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    return metrics.orderBy(F.desc("audit_run_at")).limit(n)


def bucket_of(score: Column) -> tuple[Column, Column]:
    """(label, order) of a score; no score is in the last bucket."""
    label, order = F.lit(BUCKETS[-1][0]), F.lit(len(BUCKETS))
    for k, (name, _, high) in reversed(list(enumerate(BUCKETS[:-1], 1))):
        label, order = F.when(score < high, name).otherwise(label), F.when(score < high, k).otherwise(order)
    return label, order


def pulse(feed: DataFrame) -> DataFrame:
    """section, bucket, row_count, bucket_order: eligibility, exclusions and scores from one scan.

    The rows are first counted by (eligible, reason, bucket), which a handful of groups hold; the sections are made of those.
    """
    label, order = bucket_of(F.col("happy_factor"))
    return pulse_of(feed.groupBy(F.col("is_positive_feed_eligible").alias("eligible"), F.col("exclusion_reason").alias("reason"), label.alias("label"), order.alias("place")).agg(F.count("*").alias("n")))


def pulse_of(counts: DataFrame) -> DataFrame:
    """The sections, of counts n by (eligible, reason, label, place)."""
    total = lambda kind, bucket, place: F.struct(F.lit(kind).alias("section"), bucket.cast("string").alias("bucket"), place.cast("int").alias("bucket_order"))
    none = F.lit(0)
    tags = F.array(
        total("summary", F.when(F.col("eligible"), "eligible_row_count").when(~F.col("eligible"), "ineligible_row_count"), none),
        total("exclusion", F.col("reason"), none),
        total("score", F.col("label"), F.col("place")),
    )
    tagged = counts.select(F.explode(tags).alias("t"), "n", "eligible").filter("t.section != 'exclusion' or not eligible").filter("t.section != 'summary' or t.bucket is not null")
    found = tagged.groupBy("t.section", "t.bucket", "t.bucket_order").agg(F.sum("n").alias("row_count"))
    both = counts.sparkSession.createDataFrame([("summary", b, 0, 0) for b in ("eligible_row_count", "ineligible_row_count")], "section string, bucket string, bucket_order int, row_count long")
    return found.unionByName(both).groupBy("section", "bucket", "bucket_order").agg(F.sum("row_count").alias("row_count"))


def stage_snapshot(metrics: DataFrame, feed: DataFrame) -> DataFrame:
    """Five rows: how many articles each stage of the newest run has."""
    latest = status(metrics).crossJoin(feed.agg(F.count_if("is_positive_feed_eligible").alias("eligible_row_count")))  # one row each
    parts = [F.struct(F.lit(k).alias("stage_order"), F.lit(name).alias("stage"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("row_count")) for k, (name, c) in enumerate(STAGES, 1)]
    return latest.select(F.inline(F.array(*parts)))


def trends(metrics: DataFrame, parts: dict[str, str], name: str, n: int = RECENT_RUNS) -> DataFrame:
    """The recent runs, oldest first, one row per run and part."""
    rows = recent_metrics(metrics, n)
    cells = [F.struct(F.lit(k).alias("part_order"), F.lit(label).alias(name), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("row_count")) for k, (label, c) in enumerate(parts.items(), 1)]
    label = F.coalesce(F.date_format("audit_run_at", "MMM d"), F.lit("Unknown"))
    return rows.select("audit_run_at", label.alias("run_label"), F.inline(F.array(*cells))).orderBy("audit_run_at", "part_order")


PIPELINE_TREND = {"Bronze Landed": "bronze_row_count", "Silver Canonical": "silver_canonical_row_count", "Gold Scored": "gold_row_count"}
CLEANUP_TREND = {"Silver Canonical": "silver_canonical_row_count", "Silver Duplicates": "silver_duplicate_row_count"}


def shares(buckets: DataFrame, count: str = "row_count") -> DataFrame:
    """Percent of the whole, one decimal, of a table of few buckets."""
    total = buckets.agg(F.sum(count).alias("_total"))
    return buckets.crossJoin(total).withColumn("percent", F.coalesce(F.round(F.try_divide(100.0 * F.col(count), F.col("_total")), 1), F.lit(0.0))).drop("_total")  # one row


def largest_bucket(buckets: DataFrame, order: str = "bucket_order", count: str = "row_count") -> DataFrame:
    return buckets.orderBy(F.desc(count), order).limit(1)


# Row operators: what the page does with rows it has.


def summarize(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.round(F.avg("happy_factor"), 2), F.lit(0.0)).alias("avg_happy_factor"),
        F.coalesce(F.round(F.max("happy_factor"), 2), F.lit(0.0)).alias("max_happy_factor"),
        F.count_distinct(F.when(F.col("source_name") != "", strip(F.col("source_name")))).alias("source_count"),
    )


# What a story's title loses before it is compared, in order.
STORY_TITLE = ((r"\s+\|\s+[^|]+\z", ""), (r"(?U)\b\d{4,}\b", " "), (r"(?U)[^\w\s]", " "), (r"(?U)\s+", " "))


def story_title(title: Column) -> Column:
    out = F.lower(strip(F.coalesce(title, F.lit(""))))
    for pattern, other in STORY_TITLE:
        out = F.regexp_replace(out, pattern, other)
    return strip(out)


def story_url(url: Column) -> Column:
    """Lower case, without query, fragment and closing slashes of the path."""
    raw = F.regexp_replace(F.lower(strip(F.coalesce(url, F.lit("")))), r"[?#].*\z", "")
    return F.regexp_replace(raw, r"/+\z", "")


def story_key(title: str = "title", url: str = "url") -> Column:
    """struct(kind, key): by title, else by url, else by source and article."""
    by_title, by_url = story_title(F.col(title)), story_url(F.col(url))
    low = lambda c: F.lower(strip(F.coalesce(F.col(c), F.lit(""))))
    other = F.concat(low("source_name"), F.lit(":"), low("article_id"))
    kind = F.when(by_title != "", "title").when(by_url != "", "url").otherwise("fallback")
    return F.struct(kind.alias("kind"), F.when(by_title != "", by_title).when(by_url != "", by_url).otherwise(other).alias("key"))


def dedupe_stories(rows: DataFrame, *order: Column) -> DataFrame:
    """The first row, in ``order``, of each story."""
    first = Window.partitionBy("_story").orderBy(*order)
    return rows.withColumn("_story", story_key()).withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n", "_story")


def display_order(order: str) -> list[Column]:
    happy, seen, article = F.desc_nulls_last("happy_factor"), seen_at(), F.asc("article_id")
    return {
        MOST_OPTIMISTIC: [happy, seen.desc_nulls_last(), article],
        LEAST_OPTIMISTIC: [F.asc_nulls_last("happy_factor"), seen.desc_nulls_last(), article],
        MOST_RECENT: [seen.desc_nulls_last(), happy, article],
        OLDEST: [seen.asc_nulls_first(), happy, article],
    }[order]


def sort_rows(rows: DataFrame, order: str) -> DataFrame:
    return rows.orderBy(*display_order(order))


def ranked_rows(rows: DataFrame, order: str) -> DataFrame:
    """Every row with its place in a display order, ``sort_rank``, from 1."""
    return numbered(rows, display_order(order), "sort_rank")


def numbered(rows: DataFrame, by: list[Column], name: str) -> DataFrame:
    """Every row with its place in the order, from 1.

    Rows are dealt by ranges of the order and numbered within their range; a range begins after the rows of those before it,
    so no task sees all rows. The ranges are written once, since dealing the same rows again may set other bounds.
    """
    bits = 33  # the lower bits of Spark's increasing number count within a partition
    dealt = cut(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    dealt = dealt.withColumn("_range", F.shiftright("_at", bits))
    starts, n = [], 0
    for r in sorted(dealt.groupBy("_range").count().collect()):  # a row for each range
        starts.append((r[0], n))
        n += r[1]
    starts = rows.sparkSession.createDataFrame(starts, "_range long, _start long")
    within = F.col("_at").bitwiseAND((1 << bits) - 1)
    return dealt.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + within + 1).drop("_at", "_range", "_start")


def visible_stories(rows: DataFrame, order: str, *keep_first: Column) -> DataFrame:
    """Eligible stories once each, in display order."""
    return sort_rows(dedupe_stories(rows, *keep_first).filter("is_positive_feed_eligible"), order)


def timeline(rows: DataFrame) -> DataFrame:
    return rows.filter("serving_date is not null").groupBy("serving_date").agg(
        F.count("*").alias("story_count"),
        F.count_if("is_positive_feed_eligible").alias("eligible_count"),
        F.coalesce(F.round(F.avg("happy_factor"), 2), F.lit(0.0)).alias("avg_happy_factor"),
    )


def source_rankings(rows: DataFrame, limit: int = TOP_SOURCES) -> DataFrame:
    """Eligible stories by source; a missing score counts as 0 in the mean."""
    name = strip(F.coalesce(F.nullif("source_name", F.lit("")), F.lit("Unknown source")))
    mean = F.round(F.coalesce(F.sum("happy_factor"), F.lit(0.0)) / F.count("*"), 2)
    found = rows.filter("is_positive_feed_eligible").groupBy(name.alias("source_name")).agg(F.count("*").alias("story_count"), mean.alias("avg_happy_factor"))
    return found.orderBy(F.desc("story_count"), F.desc("avg_happy_factor"), "source_name").limit(limit)


def _fixed(counts: DataFrame, labels, key: str) -> DataFrame:
    """Every label in its order, with 0 where it has no rows."""
    spark = counts.sparkSession
    fixed = spark.createDataFrame([(k, *pair) for k, pair in enumerate(labels, 1)], f"bucket_order int, {key} string, bucket string")
    return F.broadcast(counts).join(fixed, key, "right").select("bucket_order", "bucket", F.coalesce("n", F.lit(0).cast("long")).alias("story_count"))


def score_distribution(rows: DataFrame) -> DataFrame:
    """Six buckets; rows without a score are in none."""
    label, _ = bucket_of(F.col("happy_factor"))
    counts = rows.filter("happy_factor is not null").groupBy(label.alias("key")).agg(F.count("*").alias("n"))  # six rows at most
    return _fixed(counts, [(b, b) for b, _, _ in BUCKETS], "key")


def eligibility_breakdown(rows: DataFrame) -> DataFrame:
    """Six reasons; rows of other reasons are in none."""
    key = F.when(F.col("is_positive_feed_eligible"), "eligible").otherwise(F.col("exclusion_reason"))
    counts = rows.select(key.alias("key")).filter(F.col("key").isin(*REASONS)).groupBy("key").agg(F.count("*").alias("n"))  # six rows at most
    return _fixed(counts, list(REASONS.items()), "key")


def safe_url(url: Column) -> Column:
    """An http or https address with a host, HTML-escaped; else null."""
    raw = strip(url)
    ok = raw.rlike(r"^(?i:https?)://[^/?#\s]+")
    out = raw
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(ok, out)


def badge(score: Column) -> Column:
    return F.when(score >= 85, "strong").when(score >= 70, "mid").otherwise("low")


def language_label(c: Column) -> Column:
    return F.when(F.coalesce(F.upper(strip(c)), F.lit("")).isin("", "UND"), "Unknown").otherwise(F.upper(strip(c)))


def geography_label(c: Column) -> Column:
    return F.coalesce(filled(c), F.lit("Unknown"))


def time_label(c: Column) -> Column:
    """A timestamp of the session's zone (UTC) as ``Apr 2, 2026 (UTC)``."""
    return F.coalesce(F.concat(F.date_format(c, "MMM d, yyyy"), F.lit(" (UTC)")), F.lit("Unknown"))


def relative_day(c: Column, as_of: datetime) -> Column:
    """Today, Yesterday, else the day, with its year where that isn't this one."""
    at, today = F.to_date(c), day(as_of)
    older = F.when(F.year(at) == F.year(today), F.date_format(at, "MMM d")).otherwise(F.date_format(at, "MMM d, yyyy"))
    return F.when(at.isNull(), "Unknown").when(at == today, "Today").when(at == F.date_sub(today, 1), "Yesterday").otherwise(older)


# The driver's side of a page: paging, facets, cache.


def total_pages(rows: int, size: int) -> int:
    if size <= 0:
        raise ValueError("a page needs rows")
    return max(1, -(-rows // size))


def page_columns(number: Column, rows: Column, size: Column) -> tuple[Column, Column]:
    """(current page, pages) of many tables at once, as ``clamp_page`` and ``total_pages`` give them."""
    pages = F.greatest(F.lit(1), F.ceil(rows / size)).cast("long")
    return F.greatest(F.lit(1).cast("long"), F.least(number.cast("long"), pages)), pages


def clamp_page(number: int, rows: int, size: int, scope_changed: bool = False) -> int:
    """1 after the scope has changed, else within the pages there are."""
    return 1 if scope_changed else bounded(number, 1, total_pages(rows, size))


def paginate(rows: DataFrame, number: int, size: int, *order: Column) -> tuple[DataFrame, int, int, int]:
    """(rows, page, pages, total) of an ordered table."""
    total = rows.count()
    page = clamp_page(number, total, size)
    return rows.orderBy(*order).offset((page - 1) * size).limit(size), page, total_pages(total, size), total


def resolve_facets(scope: Scope, languages: Callable[[Scope], set[str]], geographies: Callable[[Scope], set[str]], preserve: bool = False, rounds: int = 4) -> Scope:
    """Selections that the other facet no longer offers go, until nothing changes; ``preserve`` keeps them."""
    if preserve:
        return scope
    for _ in range(rounds):
        kept = Scope(scope.lookback_days, tuple(set(scope.languages) & languages(scope)), scope.geographies)
        kept = Scope(kept.lookback_days, kept.languages, tuple(set(kept.geographies) & geographies(kept)))
        if kept == scope:
            break
        scope = kept
    return scope


@dataclass
class TimedCache:
    """Results by a hashable key (a frozen configuration), for a number of seconds."""

    seconds: float
    clock: Callable[[], float] = time.monotonic
    held: dict[Hashable, tuple[float, object]] = field(default_factory=dict)

    def get(self, key: Hashable, make: Callable[[], object]) -> object:
        found = self.held.get(key)
        if found is None or self.clock() - found[0] >= self.seconds:
            found = self.held[key] = (self.clock(), make())
        return found[1]
