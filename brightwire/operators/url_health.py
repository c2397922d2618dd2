"""URL health: which URLs to check, how an answer is classed, the check itself.

The check runs in Python workers with an injected opener and resolver; without an opener every result is ``unchecked`` and
no request is made.
"""

from __future__ import annotations

import ipaddress
import socket
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightwire.functions.text import is_blank, strip
from brightwire.functions.times import day, instant, seen_at

# Fixed values.
RECHECK_DAYS = {"valid": 30, "timeout": 7, "unavailable": 7, "forbidden": 14}
METADATA_HOSTS = {"metadata", "metadata.google.internal"}
LOOKBACK_DAYS, MAX_URLS, TIMEOUT_SECONDS, MAX_REDIRECTS = 30, 100, 10.0, 5
RESULT_SCHEMA = "normalized_url string, checked_at timestamp, final_url string, http_status_code long, redirect_count long, status string"


def candidates(silver: DataFrame, *, as_of: datetime, days: int = LOOKBACK_DAYS) -> DataFrame:
    """The newest canonical article of each normalised URL: normalized_url, source_url, freshness_ts."""
    rows = silver.filter(~F.col("is_duplicate") & ~is_blank(F.col("normalized_url")) & ~is_blank(F.col("url")) & (F.to_date(seen_at()) >= day(as_of, days)))
    rows = rows.select("normalized_url", F.col("url").alias("source_url"), seen_at().alias("freshness_ts"), "article_id")
    newest = Window.partitionBy("normalized_url").orderBy(F.desc("freshness_ts"), F.desc("article_id"))
    return rows.withColumn("n", F.row_number().over(newest)).filter("n = 1").drop("n", "article_id")


def has_valid_syntax(url: Column) -> Column:
    """http or https (any case), a host with a dot that it doesn't begin with."""
    raw = strip(url)
    authority = F.regexp_extract(raw, r"^(?i:https?)://([^/?#]*)", 1)
    host = F.regexp_extract(F.regexp_replace(authority, r"^.*@", ""), r"^(\[[^\]]*\]|[^:]*)", 1)
    return F.coalesce((F.instr(host, ".") > 0) & ~host.startswith("."), F.lit(False))


def recheck_due(status: Column, checked_at: Column, now: Column) -> Column:
    """Never checked, or the status's window has passed; statuses without one are always due."""
    days = F.try_element_at(F.create_map(*(F.lit(x) for kv in RECHECK_DAYS.items() for x in kv)), F.lower(F.coalesce(status, F.lit("unchecked"))))
    return checked_at.isNull() | days.isNull() | (checked_at + F.make_dt_interval(days) <= now)


def due_candidates(silver: DataFrame, results: DataFrame, *, as_of: datetime, days: int = LOOKBACK_DAYS, max_urls: int | None = MAX_URLS) -> DataFrame:
    """Candidates to check now, newest first; earlier results are looked up for the candidates only."""
    rows = candidates(silver, as_of=as_of, days=days).filter(has_valid_syntax(F.col("source_url")))
    rows = rows.join(results.select("normalized_url", "status", "checked_at"), "normalized_url", "left")
    due = rows.filter(recheck_due(F.col("status"), F.col("checked_at"), instant(as_of, silver, "ingested_at")))
    due = due.select("normalized_url", "source_url", "freshness_ts")
    return due if max_urls is None else due.orderBy(F.desc("freshness_ts"), "normalized_url").limit(max(0, max_urls))


def classify_status(code: Column) -> Column:
    return (
        F.when(code.isNull(), "unavailable")
        .when(code.between(200, 299), "valid")
        .when(code.isin(401, 403), "forbidden")
        .when(code.isin(404, 410), "broken")
        .otherwise("unavailable")
    )


def class_of(code: int | None) -> str:
    if code is None:
        return "unavailable"
    if 200 <= code < 300:
        return "valid"
    return {401: "forbidden", 403: "forbidden", 404: "broken", 410: "broken"}.get(code, "unavailable")


@dataclass(frozen=True)
class Outcome:
    final_url: str
    http_status_code: int | None
    redirect_count: int
    status: str


Resolver = Callable[[str, int | None], list[str]]
#: (method, url, timeout) to (status code, Location header); raises TimeoutError or OSError.
Opener = Callable[[str, str, float], tuple[int, str | None]]


def system_resolver(host: str, port: int | None) -> list[str]:
    return [info[4][0] for info in socket.getaddrinfo(host, port, type=socket.SOCK_STREAM)]


def blocked_reason(url: str, resolve: Resolver = system_resolver) -> str | None:
    """Why a request to ``url`` must not be made; None if it may."""
    parts = urlparse(url.strip())
    host = (parts.hostname or "").strip().rstrip(".").lower()
    if parts.scheme not in ("http", "https"):
        return "blocked_non_http_scheme"
    if not host:
        return "blocked_missing_hostname"
    try:
        ipaddress.ip_address(host)
        return "blocked_ip_literal"
    except ValueError:
        pass
    if host in METADATA_HOSTS:
        return "blocked_metadata_host"
    try:
        found = resolve(host, parts.port)
    except OSError:
        found = []
    if not found:
        return "blocked_dns_resolution_failed"
    for text in found:
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return "blocked_invalid_resolution"
        if not address.is_global:
            kinds = ("loopback", "private", "link_local", "multicast", "unspecified", "reserved")
            return next((f"blocked_{k}_ip" for k in kinds if getattr(address, f"is_{k}")), "blocked_non_global_ip")
    return None


def _follow(method: str, url: str, opener: Opener, resolve: Resolver, timeout: float, max_redirects: int) -> Outcome:
    if blocked_reason(url, resolve):
        return Outcome(url, None, 0, "unavailable")
    chain = [url]
    while True:
        code, target = opener(method, chain[-1], timeout)
        hops = len(chain) - 1
        if not 300 <= code < 400:
            return Outcome(chain[-1], code, hops, class_of(code))
        if not target or hops >= max_redirects:
            return Outcome(chain[-1], code, hops, "redirect_loop")
        onward = urljoin(chain[-1], target)
        if onward in chain:
            return Outcome(onward, code, hops + 1, "redirect_loop")
        if blocked_reason(onward, resolve):
            return Outcome(onward, None, hops, "unavailable")
        chain.append(onward)


def check_url(url: str, opener: Opener | None, resolve: Resolver = system_resolver, timeout: float = TIMEOUT_SECONDS, max_redirects: int = MAX_REDIRECTS) -> Outcome:
    """HEAD along redirects, every hop through the gate; where HEAD isn't allowed, the same by GET."""
    if opener is None:
        return Outcome(url, None, 0, "unchecked")
    try:
        found = _follow("HEAD", url, opener, resolve, timeout, max_redirects)
        return _follow("GET", url, opener, resolve, timeout, max_redirects) if found.http_status_code in (405, 501) else found
    except TimeoutError:
        return Outcome(url, None, 0, "timeout")
    except OSError as error:
        slow = isinstance(getattr(error, "reason", None), TimeoutError)
        return Outcome(url, None, 0, "timeout" if slow else "unavailable")


def check_urls(due: DataFrame, *, as_of: datetime, opener: Opener | None = None, resolve: Resolver = system_resolver, parallel: int = 32) -> DataFrame:
    """Results of the due candidates, by ``parallel`` tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [check_url(u, opener, resolve) for u in batch["source_url"]]
            yield pd.DataFrame(
                {
                    "normalized_url": batch["normalized_url"],
                    "final_url": [o.final_url for o in made],
                    "http_status_code": pd.array([o.http_status_code for o in made], "Int64"),
                    "redirect_count": pd.array([o.redirect_count for o in made], "Int64"),
                    "status": [o.status for o in made],
                }
            )

    schema = "normalized_url string, final_url string, http_status_code long, redirect_count long, status string"
    found = due.repartition(parallel, "normalized_url").mapInPandas(run, schema)
    return found.select("normalized_url", F.lit(as_of.isoformat(sep=" ")).cast("timestamp").alias("checked_at"), "final_url", "http_status_code", "redirect_count", "status")
