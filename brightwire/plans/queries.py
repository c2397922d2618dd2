"""The registered queries of the news-feed operators, over the article rows derived from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwire.functions import text
from brightwire.functions.times import instant, seen_at
from brightwire.operators import feed, quality, rules, silver, url_health
from brightwire.plans import checks, ops, parts, serving
from brightwire.sources import extract, fixtures, guard, language, store, window
from brightwire.sources.fixtures import AS_OF

SCOPE = serving.Scope(30, ("EN", "DE", "FR"), ("United States", "France", "Germany", "Spain"))
#: Cutoff of the archive queries.
CUTOFF = "2024-01-16 00:00:00"


#: Models that a session has written, by application, folder and name.
_written: dict[tuple[str, str, str], DataFrame] = {}


@dataclass
class Tables:
    """The models over one set of tables, planned when asked for.

    A model that a query reads, but isn't about, is written once a session and folder (``once``), as a run of the models
    would have; queries read that table. What a query is about is always derived.
    """

    spark: SparkSession
    sf_dir: str

    def once(self, *names: str) -> Tables:
        for name in names:
            key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
            if key not in _written:
                _written[key] = store.cut(getattr(self, name), name, **store.DENSE)
            setattr(self, name, _written[key])
        return self

    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.raw(self.spark, self.sf_dir)

    @cached_property
    def named(self) -> DataFrame:
        return extract.named_fields(self.raw)

    @cached_property
    def bronze(self) -> DataFrame:
        return fixtures.bronze(self.spark, self.sf_dir)

    @cached_property
    def keyed(self) -> DataFrame:
        return self.bronze.transform(silver.clean).transform(silver.normalize).transform(silver.key)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.refine(self.bronze, as_of=AS_OF)

    @cached_property
    def terms(self) -> DataFrame:
        return rules.guardrail_terms(self.spark)

    @cached_property
    def scored(self) -> DataFrame:
        """Canonical articles with base score and hits."""
        return self.silver.transform(feed.canonical).transform(feed.with_base_score).transform(rules.with_hits, self.terms)

    @cached_property
    def feed(self) -> DataFrame:
        return feed.feed(self.silver, self.terms, as_of=AS_OF)

    @cached_property
    def urls(self) -> DataFrame:
        return fixtures.url_results(self.silver)

    @cached_property
    def quality(self) -> DataFrame:
        return quality.source_quality(self.silver, self.feed, self.urls, as_of=AS_OF)

    @cached_property
    def features(self) -> DataFrame:
        return feed.shadow_features(self.silver, self.terms, as_of=AS_OF)

    @cached_property
    def dual(self) -> DataFrame:
        return self.features.transform(feed.with_urls, self.urls).transform(feed.with_sources, self.quality).transform(feed.with_dual_scores)

    @cached_property
    def shadow(self) -> DataFrame:
        return feed.shadow_feed(self.silver, self.terms, self.urls, self.quality, as_of=AS_OF)

    @cached_property
    def labels(self) -> DataFrame:
        return fixtures.eval_labels(self.spark, self.sf_dir)

    @cached_property
    def metrics(self) -> DataFrame:
        return fixtures.metrics_history(self.silver, self.feed)


def _batches(t: Tables) -> DataFrame:
    runs = t.bronze.groupBy("ingestion_id").agg(F.min("ingested_at").alias("a"), F.max("ingested_at").alias("b"))
    return runs.select("ingestion_id", F.explode(window.batch_times(F.col("a"), F.col("b"))).alias("batch_time"))


def _explained(t: Tables) -> DataFrame:
    """Fields of the explanation, read back from its JSON."""
    names = ("positivity_score", "suitability_score", "headline_shape_penalty", "source_quality_adjustment")
    got = lambda n: F.get_json_object("score_explanation", f"$.{n}")
    return t.shadow.select(
        "article_id",
        *(got(n).cast("double").alias(n) for n in names),
        *(got(n).alias(n) for n in ("url_quality_status", "exclusion_reason")),
        got("template_repeat_count").cast("long").alias("template_repeat_count"),
        F.size(F.from_json(got("allow_terms"), "array<string>")).cast("long").alias("allow_term_count"),
    )


def _merge(t: Tables) -> DataFrame:
    """What a table holds after half of its articles arrived again with a newer run's mark."""
    old = t.bronze.select("source_record_id", "ingestion_id", "ingested_at")
    table = store.Table(t.spark, store.scratch_path(t.spark, "merge"), old.schema, sort_by=("source_record_id",), day_of="ingested_at")
    table.replace(old)
    table.upsert(old.filter(F.col("ingestion_id") >= "run_20240115").withColumn("ingestion_id", F.lit("again")), ["source_record_id"], ["ingested_at"])
    return table.read()


def _exported(t: Tables) -> DataFrame:
    """Rows older than the cutoff, exported and read back."""
    path = store.scratch_path(t.spark, "export")
    store.export(store.older_than(t.bronze, CUTOFF), path)
    return t.spark.read.parquet(path).select("source_record_id", "ingestion_id", "ingested_at", "title")


def _deleted(t: Tables) -> DataFrame:
    """What a table holds after the rows older than the cutoff were deleted from it."""
    table = store.Table(t.spark, store.scratch_path(t.spark, "delete"), t.bronze.schema, day_of="ingested_at")
    table.replace(t.bronze)
    before = table.manifest().agg(F.sum("rows")).first()[0]
    gone = table.delete_before("ingested_at", CUTOFF)
    if table.manifest().agg(F.sum("rows")).first()[0] != before - gone:
        raise RuntimeError(f"{gone} rows were to go of {before}")
    return table.read().select("source_record_id", "ingested_at")


def _url_merge(t: Tables) -> DataFrame:
    """URL results after the broken ones were checked again."""
    old = t.urls.select("normalized_url", "status", "redirect_count")
    table = store.Table(t.spark, store.scratch_path(t.spark, "urls"), old.schema, sort_by=("normalized_url",))
    table.replace(old)
    table.upsert(table.read().filter("status = 'broken'").withColumns({"status": F.lit("valid"), "redirect_count": F.col("redirect_count") + 10}), ["normalized_url"])
    return table.read()


def _daily(t: Tables, *layers: str) -> parts.Parts:
    """Parts of the layers: those of all days up to the 15th first, as earlier runs left them, then those of the days since, by a run that reads only these. A layer's table has all of its rows, and the columns that parts are made of."""
    found = parts.Parts(t.spark, store.scratch_path(t.spark, "parts"), t.bronze.schema["ingested_at"].dataType.simpleString())
    for layer in layers:
        rows, day = getattr(t, layer).select(*parts.READS[layer]), parts.DAY_OF[layer]
        layout = {"day_of": day} if day == "ingested_at" else {"partition_by": (day,)}
        table = store.Table(t.spark, store.scratch_path(t.spark, layer), rows.schema, **layout)
        table.replace(rows)
        for first, last in ((date(2000, 1, 1), date(2024, 1, 14)), (date(2024, 1, 15), date(2024, 1, 15)), (date(2024, 1, 15), date(2100, 1, 1))):
            found.refresh(layer, table, first, last)
    return found


def _sought(t: Tables) -> DataFrame:
    """The third page of the brief, opened by the place where the second one ends."""
    scope, size, order = serving.Scope(30), 10, serving.LEAST_OPTIMISTIC
    end = serving.page_ends(t.feed, scope, size, order, as_of=AS_OF).filter("page = 2").first()
    after = None if end is None else serving.Seek(end.happy_factor, end.seen_at, end.article_id)
    return serving.brief_after(t.feed, scope, after, size, order, as_of=AS_OF)


def _cached_columns(t: Tables) -> DataFrame:
    return store.introspect(t.feed)


def _lang_norm(t: Tables) -> DataFrame:
    """Each document's language, from codes of two or three letters with and without a tail, and from codes that are none."""
    c, long = F.col("lang"), F.create_map(*map(F.lit, ("en", "eng", "fr", "fra", "de", "ger", "es", "SPA")))
    kind = F.col("doc_id") % 4
    code = F.when(kind == 0, c).when(kind == 1, F.concat(F.upper(c), F.lit("_"))).when(kind == 2, F.coalesce(long[c], c)).otherwise(F.concat(F.lit("zz"), c))
    rows = fixtures.table(t.spark, t.sf_dir, "documents").select("doc_id", code.alias("code"))
    return rows.withColumn("language", extract.language_alpha2(F.col("code")))


def _lang_infer(t: Tables) -> DataFrame:
    """Each document's language by profiles learnt from four fifths of the documents; held_out: not learnt from."""
    docs, held = fixtures.table(t.spark, t.sf_dir, "documents").select("doc_id", "text", "lang"), F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    profiles = language.fit(docs.filter(~held))
    return docs.select("doc_id", "lang", held.alias("held_out"), extract.infer_language(F.col("text"), profiles).alias("language"))


def _classes(t: Tables) -> DataFrame:
    """The status of each page, were its HTTP code 100 to 599 by its id, or missing."""
    code = F.when(F.col("page_id") % 50 != 49, (100 + F.col("page_id") % 500).cast("int"))
    return fixtures.table(t.spark, t.sf_dir, "pages").select("page_id", code.alias("code")).withColumn("status", url_health.classify_status(F.col("code")))


def _page_math(t: Tables) -> DataFrame:
    """Each source's stories in pages of 1 to 10, and the page that is shown of a page asked for."""
    number = F.min(F.expr("cast(substring(source_record_id, 2) as bigint)")) % 13
    rows = t.feed.groupBy("source_name").agg(F.count("*").alias("row_count"), number.alias("page"), (1 + F.count("*") % 10).alias("size"))
    current, pages = serving.page_columns(F.col("page"), F.col("row_count"), F.col("size"))
    return rows.select("source_name", "page", "row_count", "size", current.alias("current_page"), pages.alias("total_pages"))


def _active_terms(t: Tables) -> DataFrame:
    """The terms that are active where soft denials and phrases are switched off, and the titles that have them."""
    some = t.terms.withColumn("is_active", F.expr("rule_class <> 'deny_soft' and match_scope = 'token'"))
    return rules.term_use(rules.active_terms(some), t.silver.transform(feed.canonical).transform(rules.with_hits, some))


def _fields(part: str, df: DataFrame, keyed: bool) -> DataFrame:
    """(part, key, field, value) of every cell; the first column is the key, or the part is one row."""
    fields = df.columns[keyed:]
    cells = [F.struct(F.lit(part).alias("part"), (F.col(df.columns[0]) if keyed else F.lit("all")).alias("key"), F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields]
    return df.select(F.inline(F.array(*cells)))


def _all_compared(t: Tables) -> DataFrame:
    """The ten parts of the comparison, cell by cell."""
    single = ("overlap", "current_precision", "shadow_precision")
    return reduce(DataFrame.unionByName, (_fields(n, df, n not in single) for n, df in ops.compare(t.feed, t.shadow, t.silver, t.labels).items()))


def _all_sorts(t: Tables) -> DataFrame:
    """Every row of the feed in each display order, with its place there."""
    names = (serving.MOST_OPTIMISTIC, serving.MOST_RECENT, serving.OLDEST)
    rows = store.cut(t.feed.select("article_id", "happy_factor", "published_at", "ingested_at"), "feed")
    ranked = [serving.ranked_rows(rows, o).select(F.lit(o).alias("sort_order"), "sort_rank", "article_id", "happy_factor") for o in names]
    return reduce(DataFrame.unionByName, ranked)


def _all_declared(t: Tables) -> DataFrame:
    """The checks of all nine tables that declare some; metrics as one run's row, which has all of its columns."""
    metrics = quality.run_metrics(t.bronze, t.silver, t.feed, as_of=AS_OF)
    tables = {"bronze": t.bronze, "silver": t.silver, "terms": t.terms, "feed": t.feed, "url_results": t.urls, "source_quality": t.quality, "shadow": t.shadow, "metrics": metrics, "labels": t.labels}
    return reduce(DataFrame.unionByName, (checks.column_checks(tables[n], declared).select(F.lit(n).alias("table_name"), "*") for n, declared in checks.DECLARED.items()))


def _custom(t: Tables) -> DataFrame:
    return checks.report(checks.custom_checks(t.bronze, t.silver, t.feed, t.shadow, t.quality, t.metrics, as_of=AS_OF))


def _guard(t: Tables) -> DataFrame:
    return guard.guard_verdict(extract.run_stats(t.named), guard.recent_runs(t.bronze))


def _hits(df: DataFrame) -> DataFrame:
    return df.select("source_record_id", "allow_token_hit_count", "allow_phrase_hit_count", "allow_hit_count", "soft_deny_hit_count", "hard_deny_hit_count")


def _terms_of(df: DataFrame) -> DataFrame:
    return df.select("source_record_id", *(F.array_join(f"{n}_terms", ",").alias(f"{n}_terms") for n in ("allow", "soft_deny", "hard_deny")))


def _resolved(t: Tables) -> DataFrame:
    code, status = extract.resolve_language(F.col("native"), F.lit(None).cast("string"))
    rows = t.named.select("line", extract.language_raw(F.col("translation_info")).alias("native"))
    return rows.select("line", code.alias("language"), status.alias("language_resolution_status"))


def _country(t: Tables) -> DataFrame:
    rows = t.named.select("line", extract.country(text.filled(F.col("locations"))).alias("found"))
    return rows.select("line", F.col("found.code").alias("mentioned_country_code"), F.col("found.name").alias("mentioned_country_name"), F.col("found.status").alias("resolution_status"))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # sources and sinks
    "src_batches": _batches,
    "src_malformed": lambda t: extract.malformed_reasons(t.named),
    "src_run_guard": _guard,
    "src_recent_runs": lambda t: guard.recent_runs(t.bronze),
    "sink_merge": _merge,
    "sink_export": _exported,
    "sink_delete": _deleted,
    "src_columns": _cached_columns,
    "src_literal": lambda t: rules.term_use(t.terms, t.scored),
    # extraction
    "ext_nullif": lambda t: t.named.select("line", text.filled(F.col("source_record_id")).alias("source_record_id"), text.filled(F.col("source_collection_identifier")).alias("collection")),
    "ext_domain": lambda t: t.named.select("line", extract.domain(F.when(text.filled(F.col("source_collection_identifier")) == "1", text.filled(F.col("document_identifier"))), text.filled(F.col("source_name"))).alias("source_domain")),
    "ext_title": lambda t: t.named.select("line", extract.page_title(F.col("extras")).alias("title")),
    "ext_lang_raw": lambda t: t.named.select("line", extract.language_raw(F.col("translation_info")).alias("language_raw")),
    "ext_lang_norm": _lang_norm,
    "ext_lang_resolve": _resolved,
    "ext_lang_infer": _lang_infer,
    "ext_country": _country,
    "ext_ts": lambda t: t.named.select("line", F.date_format(extract.timestamp(F.col("published")), "yyyyMMddHHmmss").alias("published"), F.coalesce(F.col("malformed_reason"), F.lit("ok")).alias("row_state")),
    "ext_tone": lambda t: t.named.select("line", extract.tone(F.col("tone")).alias("tone_raw"), extract.bad_tone(F.col("tone")).alias("bad_tone")),
    # silver
    "slv_clean": lambda t: t.bronze.transform(silver.clean),
    "slv_title": lambda t: t.keyed.select("source_record_id", "title", "normalized_title"),
    "slv_url": lambda t: t.keyed.select("source_record_id", "normalized_url"),
    "slv_article_id": lambda t: t.keyed.select("source_record_id", "article_id"),
    "slv_dedup_key": lambda t: t.keyed.select("source_record_id", "dedup_key"),
    "slv_dedup_rank": lambda t: t.silver.select("article_id", "dedup_key", "is_duplicate"),
    "slv_near_dup": lambda t: t.silver.select("article_id", "is_near_duplicate_candidate"),
    "slv_retention": lambda t: silver.retain(t.keyed, AS_OF, 20).select("source_record_id"),
    # canonical feed
    "gld_canonical": lambda t: t.silver.transform(feed.canonical).select("article_id", "serving_date"),
    "gld_active_terms": _active_terms,
    "gld_tokens": lambda t: t.silver.transform(feed.canonical).select("article_id", F.array_join(text.tokens(F.col("title")), " ").alias("title_tokens"), text.spaced(F.col("title")).alias("normalized_title")),
    "gld_rule_hits": lambda t: _hits(t.scored),
    "gld_base_score": lambda t: t.scored.select("article_id", "tone_score", "base_happy_factor"),
    "gld_happy": lambda t: t.feed.select("article_id", "base_happy_factor", "happy_factor", "happy_factor_version"),
    "gld_eligible": lambda t: t.feed.select("article_id", "is_positive_feed_eligible"),
    "gld_reason": lambda t: t.feed.select("article_id", "exclusion_reason", "positive_guardrail_version"),
    "gld_retention": lambda t: feed.feed(t.silver, t.terms, as_of=AS_OF + timedelta(days=170)).select("article_id", "serving_date"),
    "gld_feed": lambda t: t.feed,
    # dual-score feed
    "v3_features": lambda t: t.features.select("article_id", "title_token_count", "uppercase_token_count", "title_template_prefix"),
    "v3_templates": lambda t: feed.template_counts(t.silver.transform(feed.canonical).transform(feed.headline_features), AS_OF),
    "v3_rule_hits": lambda t: _terms_of(t.scored),
    "v3_headline": lambda t: t.features.select("article_id", "has_punctuation_bait", "has_gallery_bait", "uppercase_ratio", "template_repeat_count"),
    "v3_url": lambda t: t.dual.select("article_id", "has_title", "has_url", "has_valid_url", "url_quality_status", "url_quality_checked_at", "url_http_status"),
    "v3_source": lambda t: t.dual.select("article_id", "source_domain", "source_quality_tier", "source_quality_adjustment"),
    "v3_positivity": lambda t: t.dual.select("article_id", "base_happy_factor", "constructive_bonus", "positivity_score"),
    "v3_penalties": lambda t: t.dual.select("article_id", "headline_shape_penalty", "url_quality_penalty"),
    "v3_suitability": lambda t: t.dual.select("article_id", "suitability_score"),
    "v3_happy": lambda t: t.shadow.select("article_id", "happy_factor", "happy_factor_version"),
    "v3_reason": lambda t: t.shadow.select("article_id", "exclusion_reason"),
    "v3_gate_reason": lambda t: t.shadow.select("article_id", "suitability_gate_reason"),
    "v3_eligible": lambda t: t.shadow.select("article_id", "is_positive_feed_eligible"),
    "v3_explain": _explained,
    "v3_feed": lambda t: t.shadow.drop("score_explanation"),
    # url health
    "url_candidates": lambda t: url_health.candidates(t.silver, as_of=AS_OF),
    "url_syntax": lambda t: t.bronze.select("source_record_id", url_health.has_valid_syntax(F.col("source_url")).alias("has_valid_syntax")),
    "url_recheck": lambda t: t.urls.select("normalized_url", url_health.recheck_due(F.col("status"), F.col("checked_at"), instant(AS_OF, t.urls, "checked_at")).alias("is_due")),
    "url_due": lambda t: url_health.due_candidates(t.silver, t.urls, as_of=AS_OF, max_urls=None).select("normalized_url", "source_url"),
    "url_classify": _classes,
    "url_merge": _url_merge,
    # aggregates
    "agg_metrics": lambda t: quality.run_metrics(t.bronze, t.silver, t.feed, as_of=AS_OF),
    "agg_metrics_parts": lambda t: parts.run_metrics(_daily(t, "bronze", "silver", "feed"), as_of=AS_OF),
    "agg_latest_run": lambda t: quality.latest_run(t.bronze),
    "agg_source_quality": lambda t: t.quality.drop("source_quality_tier", "source_quality_adjustment"),
    "agg_quality_tier": lambda t: t.quality.select("source_domain", "source_quality_tier", "source_quality_adjustment"),
    "agg_scope_summary": lambda t: serving.scope_summary(t.feed, serving.Scope(30), as_of=AS_OF),
    "agg_overlap": lambda t: ops.overlap(t.feed, t.shadow),
    "agg_exclusion_dist": lambda t: ops.exclusions(t.feed),
    "agg_domain_mix": lambda t: ops.domain_mix(t.feed, t.silver),
    "agg_link_mix": lambda t: ops.link_mix(t.shadow),
    "agg_label_precision": lambda t: ops.label_precision(t.feed, t.labels),
    "agg_having": lambda t: ops.weak_domains(ops.sample_buckets(t.feed, t.silver, as_of=AS_OF, days=30)),
    "agg_distinct": lambda t: t.silver.select("language", "mentioned_country_name").distinct(),
    "agg_array_distinct": lambda t: t.scored.groupBy("source_name").agg(F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("allow_terms")))), ",").alias("allow_terms")),
    "agg_string_ordered": lambda t: t.silver.transform(feed.canonical).transform(feed.headline_features).select("article_id", "title_template_prefix"),
    # windows
    "win_dedup": lambda t: silver.with_ranks(t.keyed).select("article_id", F.col("dedup_rank").cast("long").alias("dedup_rank")),
    "win_count": lambda t: silver.with_title_counts(t.keyed).filter("normalized_title is not null").select("article_id", "normalized_title_day_count"),
    "win_url": lambda t: url_health.candidates(t.silver, as_of=AS_OF, days=15),
    "win_runs": lambda t: checks.ranked(t.metrics, F.desc("audit_run_at")).select(F.col("run_rank").cast("long").alias("run_rank"), "ingestion_id", "gold_row_count"),
    # order, limit, sets, predicates
    "srt_feed": lambda t: serving.feed_rows(t.feed, as_of=AS_OF, lookback_days=30, limit=100).select("article_id", "happy_factor", "serving_date"),
    "srt_brief": lambda t: serving.brief_rows(t.feed, serving.Scope(30), serving.Page(3, 10, serving.LEAST_OPTIMISTIC), as_of=AS_OF).select("article_id", "happy_factor"),
    "srt_brief_seek": lambda t: _sought(t).select("article_id", "happy_factor"),
    "srt_changed": lambda t: ops.changed_rows(t.feed, t.shadow, t.silver, "newly_excluded"),
    "set_union": lambda t: serving.pulse(t.shadow),
    "prd_scope": lambda t: serving.in_scope(t.feed, SCOPE, AS_OF).select("article_id"),
    "prd_between": lambda t: t.feed.filter(F.col("happy_factor").between(60, 75)).select("article_id", "happy_factor"),
    "prd_suspicious": lambda t: ops.suspicious_urls(t.silver.withColumn("url", F.regexp_replace("url", r"//(blog|m)\.", "//10."))).select("article_id", "url"),
    # serving
    "srv_feed": lambda t: serving.feed_rows(t.feed, as_of=AS_OF, lookback_days=30),
    "srv_brief_rows": lambda t: serving.brief_rows(t.feed, SCOPE, serving.Page(1, 50), as_of=AS_OF),
    "srv_summary": lambda t: serving.scope_summary(t.feed, SCOPE, as_of=AS_OF),
    "srv_langs": lambda t: serving.language_options(t.feed, SCOPE, as_of=AS_OF),
    "srv_geos": lambda t: serving.geography_options(t.feed, SCOPE, as_of=AS_OF),
    "srv_status": lambda t: serving.status(t.metrics),
    "srv_pulse": lambda t: serving.pulse(t.feed),
    "srv_pulse_parts": lambda t: parts.pulse(_daily(t, "feed")),
    "srv_stage_snapshot": lambda t: serving.stage_snapshot(t.metrics, t.feed),
    "srv_trends": lambda t: serving.trends(t.metrics, serving.PIPELINE_TREND, "stage").select("audit_run_at", "run_label", "stage", "row_count"),
    "srv_cleanup_trend": lambda t: serving.trends(t.metrics, serving.CLEANUP_TREND, "bucket").select("audit_run_at", "run_label", "bucket", "row_count"),
    "srv_share": lambda t: serving.shares(serving.pulse(t.feed).filter("section = 'score'")).select("bucket", "row_count", "percent"),
    "srv_safe_url": lambda t: t.bronze.select("source_record_id", serving.safe_url(F.col("source_url")).alias("safe_url")),
    "srv_page_math": _page_math,
    "srv_badge": lambda t: t.feed.select("article_id", serving.badge(F.col("happy_factor")).alias("badge"), serving.language_label(F.col("language")).alias("language_label"), serving.geography_label(F.col("mentioned_country_name")).alias("geography_label")),
    # row operators
    "row_summary": lambda t: serving.summarize(t.feed),
    "row_story_dedup": lambda t: serving.dedupe_stories(t.feed, F.desc("happy_factor"), F.desc(seen_at()), F.desc("article_id")).select("article_id"),
    "row_story_key": lambda t: t.feed.select("article_id", serving.story_key()["kind"].alias("kind"), serving.story_key()["key"].alias("key")),
    "row_sorts": _all_sorts,
    "row_sorts_all": _all_sorts,
    "row_timeline": lambda t: serving.timeline(t.feed),
    "row_source_rank": lambda t: serving.source_rankings(t.feed),
    "row_score_dist": lambda t: serving.score_distribution(t.feed),
    "row_elig_breakdown": lambda t: serving.eligibility_breakdown(t.feed),
    # operations and checks
    "ops_report": lambda t: ops.daily_report(t.metrics, t.feed, as_of=AS_OF),
    "ops_sample": lambda t: ops.review_sample(t.feed, t.silver, as_of=AS_OF),
    "ops_compare": _all_compared,
    "ops_compare_all": _all_compared,
    "chk_column": _all_declared,
    "chk_column_all": _all_declared,
    "chk_custom": _custom,
}


def _reads(name: str) -> tuple[str, ...]:
    """The models that a query reads as written tables."""
    about, silver_only = name.split("_")[0], ("gld", "url", "v3")
    if name in ("url_syntax", "win_dedup", "win_count"):
        return ()
    if name in ("agg_overlap", "agg_link_mix", "srt_changed", "set_union", "ops_compare", "ops_compare_all"):
        return ("silver", "feed", "urls", "quality", "shadow")
    if name in ("chk_column", "chk_column_all"):
        return ("bronze", "silver", "feed", "urls", "quality", "shadow")
    if about == "chk":
        return ("bronze", "silver", "feed", "urls", "quality", "shadow", "metrics")
    if name in ("agg_metrics", "agg_metrics_parts", "agg_latest_run", "srv_pulse_parts"):
        return ("bronze", "silver", "feed")
    if name in ("win_runs", "srv_status", "srv_stage_snapshot", "srv_trends", "srv_cleanup_trend", "ops_report"):
        return ("silver", "feed", "metrics")
    if about == "v3" and name not in ("v3_features", "v3_templates", "v3_rule_hits", "v3_headline"):
        return ("silver", "feed", "urls", "quality")
    if about in silver_only or name in ("src_literal", "agg_distinct", "agg_array_distinct", "agg_string_ordered", "win_url", "prd_suspicious"):
        return ("silver",)
    return ("silver", "feed") if about in ("agg", "srt", "prd", "srv", "row", "ops") else ()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def made(name: str, make: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: make(Tables(spark, sf_dir).once(*_reads(name)))

    return {name: made(name, make) for name, make in QUERIES.items()}
