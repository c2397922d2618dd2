"""Windows, archives, extraction, guards, tables, URL health, operations."""

import io
import json
import zipfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from brightwire.operators import url_health
from brightwire.plans import ops
from brightwire.sources import archive, extract, guard, store, window
from brightwire.streaming import ingest

UTC = timezone.utc


def row(**change):
    fields = [""] * 27
    sample = {
        0: "record-1", 1: "20260402164500", 2: "1", 3: "Example.com", 4: "https://example.com/news/story", 6: "COUNT", 8: "THEME",
        10: "1#American#US#US##39.82#-98.57#US#1", 12: "PERSON", 14: "ORG", 15: "1.5,0,0,0,0,0,0", 17: "GCAM", 23: "ALL_NAMES", 24: "AMOUNTS",
        25: "source:foo;srclc:eng;", 26: "<PAGE_TITLE>Markets rally again</PAGE_TITLE>",
    }
    for k, v in (sample | {int(k[1:]): v for k, v in change.items()}).items():
        fields[k] = v
    return fields


def zipped(*rows, name="20260402164500.gkg.csv"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, "\n".join("\t".join(r) for r in rows).encode())
    return out.getvalue()


def raw(spark, *rows):
    return spark.createDataFrame([("f", n, r) for n, r in enumerate(rows)], archive.RAW_SCHEMA)


def bronze(spark, *rows):
    when = datetime(2026, 4, 2, 17)
    return extract.to_bronze(raw(spark, *rows), ingestion_id="run", ingested_at=when, window_start=when, window_end=when)


def test_window():
    now = datetime(2026, 4, 2, 6, 30, tzinfo=UTC)
    rolling = window.Window(now - timedelta(hours=1), now)
    midnight = "2026-04-02T00:00:00Z"
    assert window.requested_window(None, None, now) == rolling
    assert window.requested_window(midnight, midnight, now, deployed=True) == rolling
    assert window.requested_window(midnight, midnight, now).start.hour == 0
    with pytest.raises(ValueError):
        window.requested_window("2026-04-03", "2026-04-02", now)
    span = window.Window(datetime(2026, 4, 2, 10, 7), datetime(2026, 4, 2, 12, 1))
    assert [t.strftime("%H%M") for t in window.select_batches(span)] == ["1115", "1130", "1145", "1200"]
    assert len(window.select_batches(span, 0)) == 9


def test_window_columns_agree(spark):
    span = window.Window(datetime(2026, 4, 2, 10, 7, 3), datetime(2026, 4, 2, 12, 1, 59))
    df = spark.createDataFrame([(span.start, span.end)], "a timestamp_ntz, b timestamp_ntz")
    for n in (4, 0, 100):
        assert df.select(window.batch_times(F.col("a"), F.col("b"), n).alias("x")).first().x == window.select_batches(span, n)


def test_url_gate():
    batch = datetime(2026, 4, 2, 16, 45)
    url = window.batch_url("http://data.example.org/v2/", batch, "data.example.org")
    assert url == "http://data.example.org/v2/20260402164500.gkg.csv.zip"
    window.check_download_url(url, batch, "data.example.org")
    for bad, host in ((url.replace("data.", "evil."), "data.example.org"), (url.replace("1645", "1700"), "data.example.org"), (url + ".exe", "data.example.org")):
        with pytest.raises(ValueError):
            window.check_download_url(bad, batch, host)
    with pytest.raises(ValueError):
        window.batch_url("http://other.example.org", batch, "data.example.org")
    with pytest.raises(ValueError):
        window.batch_url("no-host", batch)


def test_archives(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped(row(), row(_0="record-2")[:26], [*row(), "more"]))
    named = extract.named_fields(archive.read_archives(spark, str(tmp_path)))
    stats = extract.run_stats(named).first()
    assert (stats[0], stats[1], stats[2]) == (3, 1, 2)
    assert dict(map(tuple, extract.malformed_reasons(named).collect())) == {"width_mismatch": 2}
    with pytest.raises(RuntimeError, match="zip_read_failure"):
        list(archive.read_rows(b"no zip", "x"))
    empty = io.BytesIO()
    zipfile.ZipFile(empty, "w").close()
    with pytest.raises(RuntimeError, match="zip_read_failure"):
        list(archive.read_rows(empty.getvalue(), "x"))


def test_fetch_skips_missing(spark):
    data = zipped(row())
    batches = [datetime(2026, 4, 2, 16, 45), datetime(2026, 4, 2, 17)]
    fetch = lambda url: (data, url) if "1645" in url else None
    assert archive.fetch_archives(spark, "http://h.example/v2", batches, "h.example", fetch).count() == 1


@pytest.fixture
def server():
    """Serves archives by stamp; the first two requests of the third file fail, the fourth file always does."""
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from threading import Thread

    data, asked = zipped(row(), row(_0="record-2")), []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            known = {"1645": True, "1700": True, "1715": asked.count(self.path) > 2}
            stamp = self.path.rpartition("/")[2][8:12]
            code = 404 if stamp == "1730" else 200 if known.get(stamp) else 503
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(data)

        def log_message(self, *args):
            pass

    httpd = HTTPServer(("127.0.0.1", 0), Handler)
    Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}/v2", asked
    httpd.shutdown()


def test_batches_are_a_data_source(spark, server):
    base, asked = server
    batches = [datetime(2026, 4, 2, 16, 45), datetime(2026, 4, 2, 17), datetime(2026, 4, 2, 17, 15), datetime(2026, 4, 2, 17, 30)]
    spark.dataSource.register(archive.Archives)
    stamps = ",".join(f"{b:%Y%m%d%H%M%S}" for b in batches)
    raw = spark.read.format("news_archives").options(base_url=base, allowed_host="127.0.0.1", batches=stamps, pause_seconds="0.01").load()
    assert raw.rdd.getNumPartitions() == 4
    rows = raw.collect()
    assert sum(r.line >= 0 for r in rows) == 6 and [r.source_file[-18:-12] for r in rows if r.line < 0] == ["173000"]
    assert sum("1715" in p for p in asked) == 3 and sum("1645" in p for p in asked) == 1
    again = archive.read_batches(spark, base, batches[:1] + batches[3:], "127.0.0.1")
    assert archive.landed(again).count() == 2 and archive.missing_batches(again).count() == 1
    assert {r.rows for r in archive.batches_found(again).collect()} == {2}
    assert archive.fetch_archives(spark, base, [], "127.0.0.1").count() == 0


def test_a_download_that_keeps_failing_stops_the_run(spark, server):
    base, asked = server
    with pytest.raises(Exception, match="503"):
        archive.fetch_archives(spark, base, [datetime(2026, 4, 2, 18)], "127.0.0.1", attempts="2", pause_seconds="0.01").count()
    assert len(asked) == 2
    with pytest.raises(ValueError):
        archive.read_batches(spark, "http://other.example", [datetime(2026, 4, 2)], "127.0.0.1")
    data = zipped(row())
    moved = lambda url: (data, "http://evil.example/x.zip")
    with pytest.raises(Exception, match="evil.example"):
        archive.fetch_archives(spark, base, [datetime(2026, 4, 2, 18)], "127.0.0.1", moved).count()


def test_bronze_row(spark):
    (got,) = bronze(spark, row()).collect()
    assert (got.source_domain, got.title, got.language, got.language_resolution_status) == ("example.com", "Markets rally again", "en", "native")
    assert (got.mentioned_country_code, got.mentioned_country_name) == ("US", "United States")
    assert got.tone_raw == 1.5 and got.published_at == datetime(2026, 4, 2, 16, 45)
    payload = json.loads(got.raw_payload)
    assert list(payload)[:2] == ["gkg_source_file", "gkg_source_collection_identifier"] and len(payload) == 19
    assert payload["bronze_run_accepted_row_count"] == 1


def test_bronze_edges(spark):
    rows = [row(), row(_0=" "), row(_1="not-a-timestamp"), row(_1="0", _2="2", _3=" WWW.Src.com ", _15="", _25="", _26="<PAGE_TITLE>A &amp; B</PAGE_TITLE>")]
    named = extract.named_fields(raw(spark, *rows))
    assert dict(map(tuple, extract.malformed_reasons(named).collect())) == {"missing_source_record_id": 1, "timestamp_parse_failure": 1}
    last = [r for r in bronze(spark, *rows).collect() if r.source_collection_identifier == "2"][0]
    assert (last.source_url, last.source_domain, last.title, last.language, last.published_at, last.tone_raw) == (None, "src.com", "A & B", "und", None, None)


@pytest.mark.parametrize(
    ("locations", "expected"),
    [
        ("1#A#US#x;1#B#CA#x;1#C#US#x", ("US", "United States", "v2_locations")),
        ("1#A#CA#x;1#B#US#x", ("CA", "Canada", "v2_locations")),
        ("bad-data-without-hash", ("ZZ", "Unknown", "undetermined")),
        ("1#A#XX#x;1#A#XX#x;1#B#US#x", ("ZZ", "Unknown", "undetermined")),
        (None, ("ZZ", "Unknown", "undetermined")),
    ],
)
def test_country(spark, locations, expected):
    df = spark.createDataFrame([(locations,)], "l string").select(extract.country(F.col("l")).alias("c"))
    assert tuple(df.first().c) == expected


def test_domains(spark):
    urls = ["https://www.example.com/news/story", "http://User@Host.com:80/x", "example.org/path", None, "https://"]
    df = spark.createDataFrame([(u, "WWW.Name.com") for u in urls], "u string, n string")
    assert [r.d for r in df.select(extract.domain(F.col("u"), F.col("n")).alias("d")).collect()] == ["example.com", "user@host.com", "example.org", "name.com", "name.com"]


def test_language_detector(spark):
    detector = lambda text: ("FR", 0.9) if "bonjour" in text else ("de", 0.5)
    df = spark.createDataFrame([("bonjour tout le monde",), ("guten Tag zusammen",), ("bonjour",), (None,)], "t string")
    assert [r.x for r in df.select(extract.infer_language(F.col("t"), detector).alias("x")).collect()] == ["fr", None, None, None]


def test_guards():
    assert guard.guard_failure(10, 8, 2, [], 0.10)
    assert guard.guard_failure(40, 40, 0, [100, 120, 110])
    assert guard.guard_failure(82, 80, 2, [100, 120, 110]) is None
    assert guard.guard_failure(0, 0, 0, []) and guard.guard_failure(5, 0, 0, [])


def test_table(spark, tmp_path):
    t = store.Table(spark, f"file://{tmp_path}/t", "k string, v long, ingested_at timestamp")
    assert t.read().count() == 0
    now = datetime(2026, 4, 1)
    frame = lambda *rows: spark.createDataFrame(list(rows), t.schema)
    t.replace(frame(("a", 1, now), ("b", 1, now)))
    t.upsert(frame(("b", 2, now), ("c", 3, now), ("c", 4, now + timedelta(1))), ["k"], ["ingested_at"])
    assert sorted((r.k, r.v) for r in t.read().collect()) == [("a", 1), ("b", 2), ("c", 4)]
    t.append(frame(("d", 5, now)))
    assert t.delete("v < 3") == 2
    assert sorted(r.k for r in t.read().collect()) == ["c", "d"]
    t.truncate()
    assert t.read().count() == 0


def test_archive_states(spark, tmp_path):
    t = store.Table(spark, f"file://{tmp_path}/t", "k string, ingested_at timestamp")
    old, new = datetime(2026, 1, 1), datetime(2026, 4, 11)
    t.replace(spark.createDataFrame([("a", old), ("b", old), ("c", new)], t.schema))
    run = lambda **o: ops.archive(spark, t, f"file://{tmp_path}/archive", started=datetime(2026, 4, 12, 3), **o)
    dry = run(dry_run=True)
    assert (dry.phase_completed, dry.candidate_row_count) == ("counted", 2) and dry.archive_path.endswith("cutoff_date=2026-02-26")
    assert run(delete=True, cap=1).status == "failed" and t.read().count() == 3
    lost = run(delete=True, export_rows=lambda df, p: store.export(df.limit(1), p))
    assert lost.status == "failed" and lost.exported_row_count == 1 and t.read().count() == 3
    done = run(delete=True)
    assert (done.status, done.phase_completed, done.deleted_row_count, done.remaining_eligible_row_count) == ("ok", "deleted", 2, 0)
    assert [r.k for r in t.read().collect()] == ["c"]
    assert run().candidate_row_count == 0


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.zip").write_bytes(zipped(row(), row(_0="record-2")))
    target = store.Table(spark, f"file://{tmp_path}/bronze", bronze(spark, row()).schema)
    for extra in (None, "b.zip"):
        if extra:
            (source / extra).write_bytes(zipped(row(_0="record-2"), row(_0="record-3")))
        ingest.ingest(spark, str(source), target, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r.source_record_id for r in target.read().collect()) == ["record-1", "record-2", "record-3"]


def test_stream_is_guarded(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.zip").write_bytes(zipped(row(), *(row(_0=" ") for _ in range(3))))
    target = store.Table(spark, f"file://{tmp_path}/bronze", bronze(spark, row()).schema)
    with pytest.raises(Exception, match="malformed row ratio"):
        ingest.ingest(spark, str(source), target, str(tmp_path / "checkpoint")).awaitTermination()
    assert target.version() is None


GLOBAL = lambda host, port: ["93.184.216.34"]


def opener(pages):
    def open_(method, url, timeout):
        found = pages[(method, url)] if (method, url) in pages else pages[url]
        if isinstance(found, Exception):
            raise found
        return found

    return open_


@pytest.mark.parametrize(
    ("pages", "status", "hops"),
    [
        ({"http://a.com/": (200, None)}, "valid", 0),
        ({"http://a.com/": (301, "/b"), "http://a.com/b": (200, None)}, "valid", 1),
        ({"http://a.com/": (301, "/b"), "http://a.com/b": (302, "/")}, "redirect_loop", 2),
        ({"http://a.com/": (302, None)}, "redirect_loop", 0),
        ({("HEAD", "http://a.com/"): (405, None), ("GET", "http://a.com/"): (404, None)}, "broken", 0),
        ({"http://a.com/": TimeoutError()}, "timeout", 0),
        ({"http://a.com/": OSError()}, "unavailable", 0),
        ({"http://a.com/": (301, "http://127.0.0.1/")}, "unavailable", 0),
        ({"http://a.com/": (403, None)}, "forbidden", 0),
    ],
)
def test_check_url(pages, status, hops):
    found = url_health.check_url("http://a.com/", opener(pages), GLOBAL)
    assert (found.status, found.redirect_count) == (status, hops)


def test_gate():
    reason = lambda url, *found: url_health.blocked_reason(url, lambda h, p: list(found))
    assert reason("ftp://a.com") == "blocked_non_http_scheme" and reason("http:///x") == "blocked_missing_hostname"
    assert reason("http://10.0.0.1/") == "blocked_ip_literal" and reason("http://metadata/") == "blocked_metadata_host"
    assert reason("http://a.com") == "blocked_dns_resolution_failed" and reason("http://a.com", "10.1.1.1") == "blocked_private_ip"
    assert reason("http://a.com", "127.0.0.1") == "blocked_loopback_ip" and reason("http://a.com", "93.184.216.34") is None


def test_unchecked_without_opener(spark):
    due = spark.createDataFrame([("a.com", "http://a.com")], "normalized_url string, source_url string")
    (got,) = url_health.check_urls(due, as_of=datetime(2026, 4, 12)).collect()
    assert got.status == "unchecked" and got.http_status_code is None


def test_recheck(spark):
    now = datetime(2026, 4, 12)
    rows = [("valid", 10), ("valid", 30), ("timeout", 8), ("timeout", 6), ("forbidden", 14), ("unchecked", 1), ("broken", 0), (None, 1)]
    df = spark.createDataFrame([(s, now - timedelta(days=d)) for s, d in rows], "s string, c timestamp").unionAll(spark.createDataFrame([("valid", None)], "s string, c timestamp"))
    got = [r.d for r in df.select(url_health.recheck_due(F.col("s"), F.col("c"), F.lit(now)).alias("d")).collect()]
    assert got == [False, True, True, False, True, True, True, True, True]


def test_syntax(spark):
    urls = ["http://a.com", "HTTPS://a.com/x", "ftp://a.com", "http://localhost", "http://.a.com", "not a url!!", None, "http://u:p@a.b:80/", "  http://a.com  "]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.x for r in df.select(url_health.has_valid_syntax(F.col("u")).alias("x")).collect()] == [True, True, False, False, False, False, False, True, True]
