"""Silver to the canonical feed (v2) and to the dual-score feed (v3)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightwire.functions import scoring as s
from brightwire.functions import text as t
from brightwire.functions.times import day, seen_at
from brightwire.operators.groups import with_found
from brightwire.operators.rules import with_hits

RETENTION_DAYS, TEMPLATE_DAYS, TEMPLATE_TOKENS = 180, 7, 5
FEED_COLUMNS = (
    "source_record_id article_id serving_date published_at source_name language language_resolution_status mentioned_country_code mentioned_country_name "
    "mentioned_country_resolution_status title url tone_score base_happy_factor happy_factor happy_factor_version is_positive_feed_eligible "
    "positive_guardrail_version exclusion_reason allow_hit_count soft_deny_hit_count hard_deny_hit_count ingested_at"
).split()
SHADOW_COLUMNS = (
    "source_record_id article_id serving_date published_at source_name source_domain language language_resolution_status mentioned_country_code "
    "mentioned_country_name mentioned_country_resolution_status title url normalized_url tone_score base_happy_factor positivity_score suitability_score "
    "happy_factor happy_factor_version is_positive_feed_eligible positive_guardrail_version exclusion_reason suitability_gate_reason allow_hit_count "
    "soft_deny_hit_count hard_deny_hit_count url_quality_status url_quality_checked_at url_http_status url_quality_penalty headline_shape_penalty "
    "source_quality_adjustment score_explanation ingested_at"
).split()
EXPLAINED = (
    "base_happy_factor constructive_bonus upstream_signal_adjustment positivity_score suitability_score headline_shape_penalty url_quality_status "
    "url_quality_penalty source_quality_tier source_quality_adjustment has_punctuation_bait has_gallery_bait uppercase_ratio template_repeat_count "
    "allow_terms soft_deny_terms hard_deny_terms url_http_status exclusion_reason"
).split()


def canonical(silver: DataFrame) -> DataFrame:
    return silver.filter(~F.col("is_duplicate")).withColumn("serving_date", F.to_date(seen_at()))


def with_base_score(articles: DataFrame) -> DataFrame:
    return articles.withColumn("tone_score", F.coalesce("tone_score", F.lit(0.0))).withColumn("base_happy_factor", s.base_score(F.col("tone_score")))


def feed(silver: DataFrame, terms: DataFrame, *, as_of: datetime) -> DataFrame:
    """The canonical feed: one scored row per canonical article of the last 180 days; filtered before the scores are made."""
    c = F.col
    rows = silver.transform(canonical).filter(c("serving_date") >= day(as_of, RETENTION_DAYS)).transform(with_base_score).transform(with_hits, terms)
    score = s.v2_score(c("base_happy_factor"), c("allow_token_hit_count"), c("allow_phrase_hit_count"), c("soft_deny_hit_count"), c("allow_hit_count"))
    rows = rows.withColumn("happy_factor", score).withColumn("exclusion_reason", s.v2_reason())
    return rows.withColumns(
        {"is_positive_feed_eligible": c("exclusion_reason").isNull(), "happy_factor_version": F.lit(s.V2_VERSION), "positive_guardrail_version": F.lit(s.RULES_VERSION)}
    ).select(*FEED_COLUMNS)


def headline_features(articles: DataFrame) -> DataFrame:
    """Token counts, the five-token prefix, bait patterns."""
    title, own = F.col("title"), F.col("_own_tokens")
    rows = articles.withColumn("_own_tokens", t.tokens(title)).withColumns(
        {
            "title_token_count": t.token_count(title, own).cast("long"),
            "uppercase_token_count": t.uppercase_count(title).cast("long"),
            "title_template_prefix": F.array_join(F.slice(own, 1, TEMPLATE_TOKENS), " "),
            "has_punctuation_bait": F.coalesce(title, F.lit("")).rlike(t.PUNCTUATION_BAIT),
            "has_gallery_bait": t.spaced(title).rlike(t.GALLERY_BAIT),
        }
    )
    ratio = F.try_divide(F.col("uppercase_token_count").cast("double"), F.nullif(F.col("title_token_count"), F.lit(0)))
    return rows.withColumn("uppercase_ratio", F.round(ratio, 4)).drop("_own_tokens")


def template_counts(features: DataFrame, as_of: datetime) -> DataFrame:
    """How often a source used a title's prefix in the last week."""
    recent = features.filter((F.col("serving_date") >= day(as_of, TEMPLATE_DAYS)) & (F.col("title_template_prefix") != ""))
    return recent.groupBy("source_domain", "title_template_prefix").agg(F.count("*").alias("template_repeat_count"))


def shadow_features(silver: DataFrame, terms: DataFrame, *, as_of: datetime) -> DataFrame:
    """Canonical articles with hits and headline features. Prefixes are counted before old articles go."""
    rows = silver.transform(canonical).withColumn("source_domain", F.coalesce("source_domain", F.lit("unknown-source"))).transform(with_base_score).transform(headline_features)
    counts = template_counts(rows, as_of)
    rows = rows.filter(F.col("serving_date") >= day(as_of, RETENTION_DAYS)).transform(with_hits, terms)
    rows = with_found(rows, counts, "source_domain", "title_template_prefix")
    return rows.withColumn("template_repeat_count", F.coalesce("template_repeat_count", F.lit(0).cast("long")))


def with_urls(rows: DataFrame, url_results: DataFrame) -> DataFrame:
    found = url_results.select("normalized_url", F.col("status").alias("_status"), F.col("checked_at").alias("url_quality_checked_at"), F.col("http_status_code").alias("url_http_status"))
    return (
        with_found(rows, found, "normalized_url")
        .withColumn("url_quality_status", F.coalesce("_status", F.lit("unchecked")))
        .drop("_status")
        .withColumns({"has_title": ~t.is_blank(F.col("title")), "has_url": ~t.is_blank(F.col("url")), "has_valid_url": t.is_valid_url(F.col("normalized_url"))})
    )


def with_sources(rows: DataFrame, snapshot: DataFrame) -> DataFrame:
    found = snapshot.select("source_domain", F.col("source_quality_tier").alias("_tier"), F.col("source_quality_adjustment").alias("_adjustment"))
    rows = rows.join(found, "source_domain", "left")
    return rows.withColumns({"source_quality_tier": F.coalesce("_tier", F.lit("mixed")), "source_quality_adjustment": F.coalesce("_adjustment", F.lit(0.0))}).drop("_tier", "_adjustment")


def with_dual_scores(rows: DataFrame) -> DataFrame:
    """Positivity and suitability, their blend, and both reason ladders."""
    c = F.col
    rows = rows.withColumns(
        {
            "upstream_signal_adjustment": F.lit(0.0),
            "constructive_bonus": s.bonus(c("allow_token_hit_count"), c("allow_phrase_hit_count")),
            "headline_shape_penalty": s.headline_penalty(),
            "url_quality_penalty": s.url_penalty(c("url_quality_status")),
        }
    )
    rows = rows.withColumns({"positivity_score": s.positivity(c("base_happy_factor"), c("constructive_bonus"), c("upstream_signal_adjustment")), "suitability_score": s.suitability()})
    rows = rows.withColumns({"happy_factor": s.v3_score(c("positivity_score"), c("suitability_score")), "exclusion_reason": s.v3_reason(), "suitability_gate_reason": s.v3_reason(True)})
    return rows.withColumns({"is_positive_feed_eligible": c("exclusion_reason").isNull(), "source_quality_adjustment": s.bounded_adjustment(c("source_quality_adjustment"))})


def explain_score(rows: DataFrame) -> DataFrame:
    return rows.withColumn("score_explanation", F.to_json(F.struct(*EXPLAINED), {"ignoreNullFields": "false"}))


def shadow_feed(silver: DataFrame, terms: DataFrame, url_results: DataFrame, snapshot: DataFrame, *, as_of: datetime) -> DataFrame:
    """The dual-score feed beside the canonical one."""
    rows = shadow_features(silver, terms, as_of=as_of).transform(with_urls, url_results).transform(with_sources, snapshot).transform(with_dual_scores).transform(explain_score)
    return rows.withColumns({"happy_factor_version": F.lit(s.V3_VERSION), "positive_guardrail_version": F.lit(s.RULES_VERSION)}).select(*SHADOW_COLUMNS)
