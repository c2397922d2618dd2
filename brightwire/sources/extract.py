"""Raw rows to bronze: field extraction, containment of malformed rows, run statistics.

Everything is a column expression but HTML unescaping and, if a detector is given, language inference (pandas UDFs).
"""

from __future__ import annotations

import html
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from brightwire.functions.text import filled, strip
from brightwire.sources.archive import WIDTH
from brightwire.sources.codes import country_name, language_alpha2

# Places of the fields in a row.
FIELDS = {
    "source_record_id": 0, "published": 1, "source_collection_identifier": 2, "source_name": 3, "document_identifier": 4, "counts": 6, "themes": 8,
    "locations": 10, "persons": 12, "organizations": 14, "tone": 15, "gcam": 17, "all_names": 23, "amounts": 24, "translation_info": 25, "extras": 26,
}
# Keys of the payload, in order, and the columns they hold.
PAYLOAD = {
    "gkg_source_file": "source_file", "gkg_source_collection_identifier": "source_collection_identifier", "gkg_source_common_name": "source_name",
    "gkg_document_identifier": "document_identifier", "gkg_v2_counts": "counts", "gkg_v2_themes": "themes", "gkg_v2_locations": "locations",
    "gkg_v2_persons": "persons", "gkg_v2_organizations": "organizations", "gkg_v2_tone": "tone", "gkg_gcam": "gcam", "gkg_all_names": "all_names",
    "gkg_amounts": "amounts", "gkg_translation_info": "translation_info", "gkg_extras": "extras",
}
RUN_STATS = ("bronze_run_total_row_count", "bronze_run_accepted_row_count", "bronze_run_malformed_row_count", "bronze_run_malformed_ratio")
BRONZE_COLUMNS = (
    "ingestion_id ingested_at source_window_start source_window_end source_record_id source_collection_identifier document_identifier source_url "
    "source_name source_domain title language_raw language language_resolution_status mentioned_country_code mentioned_country_name "
    "mentioned_country_resolution_status published_at tone_raw positive_signal_raw negative_signal_raw"
).split()
MIN_TITLE, MIN_CONFIDENCE = 12, 0.60

#: Title to (language code, confidence), or None.
Detector = Callable[[str], tuple[str, float] | None]


def domain(url: Column, source_name: Column) -> Column:
    """Host of the url, lower case, without port and leading www.; else the source's name likewise."""
    rest = F.regexp_replace(url, r"^(?i:[a-z][a-z0-9+.\-]*:)?//", "")
    cut = F.when(url.rlike(r"^(?i:[a-z][a-z0-9+.\-]*:)?//"), F.regexp_extract(rest, r"^[^/?#]*", 0)).otherwise(F.regexp_extract(url, r"^[^?#]*", 0))
    host = strip(F.lower(cut))
    host = F.regexp_replace(F.substring_index(host, "/", 1), r":\d+\z", "")
    by_url = F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))
    by_name = F.nullif(F.regexp_replace(strip(F.lower(source_name)), r"^www\.", ""), F.lit(""))
    return F.coalesce(by_url, by_name)


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def raw_title(extras: Column) -> Column:
    found = F.regexp_extract(extras, r"(?s)<PAGE_TITLE>(.*?)</PAGE_TITLE>", 1)
    return F.nullif(found, F.lit(""))


def page_title(extras: Column) -> Column:
    """Only titles that hold an entity are sent to the Python worker's unescaping; it gets null for the others."""
    title = raw_title(extras)
    escaped = title.contains("&")
    return filled(F.when(escaped, unescape(F.when(escaped, title))).otherwise(title))


def language_raw(translation: Column) -> Column:
    return language_alpha2(F.nullif(F.regexp_extract(translation, r"srclc:([a-zA-Z_-]{2,8})(?:;|\z)", 1), F.lit("")))


def tone(c: Column) -> Column:
    """The first component; what is no number is null here, and counted by ``bad_tone``."""
    value = F.nullif(strip(F.get(F.split(c, ","), F.lit(0))), F.lit("")).try_cast("double")
    return F.when(~F.isnan(value), value)


def bad_tone(c: Column) -> Column:
    """A component that isn't a number: strict ingestion stops the run at it."""
    first = F.nullif(strip(F.get(F.split(c, ","), F.lit(0))), F.lit(""))
    return first.isNotNull() & first.try_cast("double").isNull()


def timestamp(c: Column) -> Column:
    return F.when(~is_no_time(c), F.try_to_timestamp(F.when(strip(c).rlike(r"^\d{14}\z"), strip(c)), F.lit("yyyyMMddHHmmss")))


def is_no_time(c: Column) -> Column:
    """Empty or 0: a row without a time, not a malformed one."""
    return strip(c).isin("", "0")


#: The third field of each entry, where it is two letters.
PLACE_CODE = r"(?:^|;)[^;#]*#[^;#]*#\s*([A-Z]{2})\s*(?=[#;]|\z)"


def _bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def country(locations: Column) -> Column:
    """struct(code, name, status): the most frequent two-letter code, of equals the first seen; without a name, unknown."""

    def most_frequent(codes: Column) -> Column:
        ranked = F.transform(F.array_distinct(codes), lambda d: F.struct(F.size(F.filter(codes, lambda x: x == d)).alias("n"), (-F.array_position(codes, d)).alias("first"), d.alias("code")))
        return F.array_max(ranked)["code"]

    best = _bound(F.regexp_extract_all(F.upper(locations), F.lit(PLACE_CODE), 1), most_frequent)
    named = _bound(best, lambda code: F.struct(code.alias("code"), country_name(code).alias("name")))
    known = lambda p: p["name"].isNotNull()
    return _bound(
        named,
        lambda p: F.struct(F.when(known(p), p["code"]).otherwise("ZZ").alias("code"), F.when(known(p), p["name"]).otherwise("Unknown").alias("name"), F.when(known(p), "v2_locations").otherwise("undetermined").alias("status")),
    )


def named_fields(raw: DataFrame) -> DataFrame:
    """Fields by name, and the reason a row is malformed (null if it isn't)."""
    fields = {name: F.get("fields", F.lit(k)) for name, k in FIELDS.items()}
    rows = raw.select("source_file", "line", F.size("fields").alias("width"), *(v.alias(k) for k, v in fields.items()))
    when = F.col("published")
    reason = (
        F.when(F.col("width") != WIDTH, "width_mismatch")
        .when(strip(F.col("source_record_id")) == "", "missing_source_record_id")
        .when(~is_no_time(when) & timestamp(when).isNull(), "timestamp_parse_failure")
    )
    return rows.withColumn("malformed_reason", reason)


def malformed_reasons(named: DataFrame) -> DataFrame:
    return named.filter("malformed_reason is not null").groupBy("malformed_reason").agg(F.count("*").alias("row_count"))


def run_stats(named: DataFrame) -> DataFrame:
    """One row."""
    total, bad = F.count("*"), F.count("malformed_reason")
    ratio = F.coalesce(F.try_divide(bad.cast("double"), total), F.lit(0.0))
    return named.agg(*(c.alias(n) for c, n in zip((total, total - bad, bad, ratio), RUN_STATS, strict=True)))


def resolve_language(native: Column, inferred: Column) -> tuple[Column, Column]:
    status = F.when(native.isNotNull(), "native").when(inferred.isNotNull(), "inferred").otherwise("undetermined")
    return F.coalesce(native, inferred, F.lit("und")), status


def infer_language(title: Column, detector: Detector | None) -> Column:
    """By the detector, of titles that are long enough; a failure or a low confidence is null."""
    if detector is None:
        return F.lit(None).cast("string")

    def one(text: str | None) -> str | None:
        words = " ".join((text or "").split())
        if len(words) < MIN_TITLE:
            return None
        try:
            found = detector(words)
        except Exception:  # a detector's failure is no finding
            return None
        return found[0] if found and found[1] >= MIN_CONFIDENCE else None

    @F.pandas_udf("string")
    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for titles in batches:
            yield titles.map(one)

    return language_alpha2(infer(title))


def to_bronze(raw: DataFrame, *, ingestion_id: str, ingested_at: datetime, window_start: datetime, window_end: datetime, detector: Detector | None = None) -> DataFrame:
    """Accepted rows as bronze rows. The run's statistics, one row, are put beside each."""
    named = named_fields(raw)
    stats = F.broadcast(run_stats(named))  # one row
    moment = lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    c = F.col
    rows = named.filter("malformed_reason is null")
    rows = rows.withColumns({n: filled(c(n)) for n in FIELDS if n not in ("published", "tone", "extras")})
    rows = rows.withColumn("source_url", F.when(c("source_collection_identifier") == "1", c("document_identifier")))
    rows = rows.withColumns({"title": page_title(c("extras")), "language_raw": language_raw(c("translation_info")), "_country": country(c("locations"))})
    rows = rows.withColumn("_inferred", infer_language(c("title"), detector))
    language, status = resolve_language(c("language_raw"), c("_inferred"))
    rows = rows.withColumns(
        {
            "source_domain": domain(c("source_url"), c("source_name")),
            "language": language,
            "language_resolution_status": status,
            "mentioned_country_code": c("_country.code"),
            "mentioned_country_name": c("_country.name"),
            "mentioned_country_resolution_status": c("_country.status"),
            "published_at": timestamp(c("published")),
            "tone_raw": tone(c("tone")),
            "positive_signal_raw": F.lit(None).cast("double"),
            "negative_signal_raw": F.lit(None).cast("double"),
            "ingestion_id": F.lit(ingestion_id),
            "ingested_at": moment(ingested_at),
            "source_window_start": moment(window_start),
            "source_window_end": moment(window_end),
            "tone": filled(c("tone")),
            "extras": filled(c("extras")),
        }
    ).crossJoin(stats)
    payload = F.struct(*(c(v).alias(k) for k, v in PAYLOAD.items()), *RUN_STATS)
    return rows.select(*BRONZE_COLUMNS, *RUN_STATS, F.to_json(payload, {"ignoreNullFields": "false"}).alias("raw_payload"))
