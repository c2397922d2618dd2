"""Continuous ingest: archives that arrive in a folder are parsed and merged into bronze, exactly once by key."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from brightwire.sources.archive import RAW_SCHEMA, _read
from brightwire.sources.extract import named_fields, run_stats, to_bronze
from brightwire.sources.guard import enforce
from brightwire.sources.store import Table, cut, remove, scratch_path


def arriving_archives(spark: SparkSession, path: str, max_files: int = 4) -> DataFrame:
    """Raw rows of the archives that appear under ``path``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.zip").option("maxFilesPerTrigger", max_files).load(path)
    return files.select("path", "content").mapInPandas(_read, RAW_SCHEMA)


def ingest(spark: SparkSession, path: str, bronze: Table, checkpoint: str, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)) -> StreamingQuery:
    """Each micro-batch is an ingestion, upserted by source_record_id; a replayed one changes nothing but its times.

    A micro-batch that fails its guards stops the stream before it lands (``RunRejected``), and is tried again by the next one.
    """

    def land(raw: DataFrame, batch: int) -> None:
        now, path = clock(), scratch_path(spark, "arrived")
        raw = cut(raw, "arrived", path)
        try:
            enforce(run_stats(named_fields(raw)), bronze.read() if bronze.version() else None, batches=1)
            rows = to_bronze(raw, ingestion_id=f"stream_{batch}", ingested_at=now, window_start=now, window_end=now)
            bronze.upsert(rows, ["source_record_id"], ["ingested_at"])
        finally:
            remove(spark, path)

    return arriving_archives(spark, path).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
