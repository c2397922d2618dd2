"""Batch archives: ZIP files with one tab-separated member, to raw rows.

A ZIP isn't splittable, so a file is a task's unit. ``read_archives`` reads a folder of any store that Spark reads;
``read_batches`` requests files through a data source with one partition a file, and tells missing ones (404).
"""

from __future__ import annotations

import csv
import io
import time
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from brightwire.sources.window import batch_url, check_download_url

WIDTH = 27
RAW_SCHEMA = "source_file string, line long, fields array<string>"
TIMEOUT_SECONDS = 60
#: The line of the row that stands for a missing file.
MISSING = -1


def read_rows(data: bytes, source: str) -> Iterator[tuple[str, int, list[str]]]:
    """The rows of an archive's first member; bytes that aren't UTF-8 become replacement characters."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            names = archive.namelist()
            if not names or not names[0]:
                raise RuntimeError(f"zip_read_failure for {source}: the archive has no first member")
            with archive.open(names[0]) as member:
                reader = csv.reader(io.TextIOWrapper(member, "utf-8", errors="replace", newline=None), delimiter="\t")
                for n, row in enumerate(reader):
                    yield source, n, row
    except zipfile.BadZipFile as error:
        raise RuntimeError(f"zip_read_failure for {source}: {error}") from error


def _frames(rows: Iterator[tuple[str, int, list[str]]], size: int = 5_000) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pd.DataFrame(held, columns=["source_file", "line", "fields"])
            held = []
    if held:
        yield pd.DataFrame(held, columns=["source_file", "line", "fields"])


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            yield from _frames(read_rows(bytes(content), path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """source_file, line, fields of every row of every archive under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return files.select("path", "content").mapInPandas(_read, RAW_SCHEMA)


#: url to (content, final url); None where the file doesn't exist; other failures raise.
Fetcher = Callable[[str], tuple[bytes, str] | None]


def http_fetcher(url: str) -> tuple[bytes, str] | None:
    from urllib.error import HTTPError
    from urllib.request import urlopen

    try:
        with urlopen(url, timeout=TIMEOUT_SECONDS) as answer:  # noqa: S310 - the URL has passed the gate
            return answer.read(), answer.geturl()
    except HTTPError as error:
        if error.code == 404:
            return None
        raise


class Refused(RuntimeError):
    """A download that failed after all its attempts."""


@dataclass
class Batch(InputPartition):
    url: str
    batch: str

    def moment(self) -> datetime:
        return datetime.strptime(self.batch, "%Y%m%d%H%M%S")


class ArchiveReader(DataSourceReader):
    """Reads one batch file a task. A failed download is tried again within the task, then Spark tries the task again."""

    def __init__(self, options: dict[str, str], fetch: Fetcher):
        self.host, self.fetch = options["allowed_host"], fetch
        self.attempts, self.pause = int(options.get("attempts", "3")), float(options.get("pause_seconds", "1"))
        stamps = [b for b in options["batches"].split(",") if b]
        self.files = [Batch(batch_url(options["base_url"], datetime.strptime(b, "%Y%m%d%H%M%S"), self.host), b) for b in stamps]

    def partitions(self) -> list[Batch]:
        return self.files

    def _content(self, part: Batch) -> tuple[bytes, str] | None:
        """The file's bytes and final address, None where it doesn't exist."""
        check_download_url(part.url, part.moment(), self.host)
        for attempt in range(self.attempts):
            try:
                found = self.fetch(part.url)
            except OSError as error:  # connections, time limits and answers other than 404
                if attempt + 1 == self.attempts:
                    raise Refused(f"{part.url}: {error}") from error
                time.sleep(self.pause * 2**attempt)
            else:
                if found is not None:
                    check_download_url(found[1], part.moment(), self.host)
                return found

    def read(self, part: Batch | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # Spark asks so where there are no partitions
            return
        found = self._content(part)
        rows = iter([(part.url, MISSING, None)]) if found is None else read_rows(*found)
        while held := list(islice(rows, 5_000)):
            columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.string(), pa.int64(), pa.list_(pa.string())), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["source_file", "line", "fields"])


class Archives(DataSource):
    """``spark.read.format("news_archives")`` with base_url, allowed_host and batches (stamps, comma-separated); attempts and pause_seconds of a download.

    A file that doesn't exist is one row with line ``MISSING`` and no fields, so that it is counted by the job that found it so.
    """

    fetch: Fetcher = staticmethod(http_fetcher)

    @classmethod
    def name(cls) -> str:
        return "news_archives"

    def schema(self) -> str:
        return RAW_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options), type(self).fetch)


def read_batches(spark: SparkSession, base_url: str, batches: list[datetime], allowed_host: str, fetch: Fetcher = http_fetcher, **options: str) -> DataFrame:
    """The rows of the batches' files and a row for each missing file; each file is a task. ``fetch`` takes the place of HTTP."""
    [batch_url(base_url, b, allowed_host) for b in batches]  # a wrong address fails before the job
    spark.dataSource.register(type("Archives", (Archives,), {"fetch": staticmethod(fetch)}))
    reader = spark.read.format("news_archives").option("base_url", base_url).option("allowed_host", allowed_host)
    return reader.option("batches", ",".join(f"{b:%Y%m%d%H%M%S}" for b in batches)).options(**options).load()


def fetch_archives(spark: SparkSession, base_url: str, batches: list[datetime], allowed_host: str, fetch: Fetcher = http_fetcher, **options: str) -> DataFrame:
    """The rows of the batches' files, nothing for missing ones."""
    return landed(read_batches(spark, base_url, batches, allowed_host, fetch, **options))


def landed(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("line") != MISSING)


def missing_batches(raw: DataFrame) -> DataFrame:
    """source_file of the files that didn't exist."""
    return raw.filter(F.col("line") == MISSING).select("source_file")


def batches_found(raw: DataFrame) -> DataFrame:
    return landed(raw).groupBy("source_file").agg(F.count("*").alias("rows"))
