"""Tables as Parquet folders: replace, append, upsert by key, delete, compact, export, truncate."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

#: Most ranges of a batch's keys by which an upsert chooses files before it reads keys.
RANGES = 256

#: Writer's options of wide scratch tables: files small enough for many tasks to read, however few wrote them.
DENSE = {"compression": "zstd", "maxRecordsPerFile": 200_000}

_scratch: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the executors share, as the session names it; made only for a local session that names none, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that the executors share")
        found = "file://" + tempfile.mkdtemp(prefix="brightwire-")
        spark.conf.set("spark.checkpoint.dir", found)
        _scratch.append((spark, found))
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under the application's name, so that a driver that died leaves one folder to delete; removed when the driver's interpreter ends."""
    _scratch.append((spark, f"{shared_dir(spark)}/brightwire/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"))
    return _scratch[-1][1]


def cut(df: DataFrame, name: str, path: str | None = None, **options) -> DataFrame:
    """``df`` as written to a scratch folder and read back. ``options`` are those of Spark's Parquet writer."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _scratch[:] = [made for made in _scratch if made[1] != path]


@atexit.register
def _clean() -> None:
    for spark, path in reversed(list(_scratch)):
        try:
            remove(spark, path)
        except Exception:  # the session has ended: nothing can be reached any more
            return


class Table:
    """Data files that are never changed, and versions, each a manifest of the files that it holds.

    ``data/write=<id>/`` has the files of one write, ``manifest/v=<n>/`` a row for each file of a version: its rows, bytes and,
    for the ``stats`` columns, least and largest value and number of nulls. ``current-<n>`` marks a version that is complete.
    A change writes what is new, then a manifest, then the mark: readers see the old version or the new one, a plan may read
    the table that it changes, and a write that failed leaves only files that no manifest names.

    Rows are laid out by ranges of (day or partition columns, ``sort_by``), so a large day is spread over several files with
    narrow ranges, and small days share a task. ``day_of`` names a timestamp by whose day the files are partitioned; that
    column isn't among the table's own. What a change costs is in proportion to the files it touches.
    """

    def __init__(self, spark: SparkSession, path: str, schema, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), keep: int = 2, day_of: str | None = None, stats: Sequence[str] = ()):
        self.spark, self.path, self.keep, self.day_of = spark, path.rstrip("/"), keep, day_of
        self.schema = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
        self.day = f"{day_of}_day" if day_of else None
        self.partition_by, self.sort_by = (*partition_by, *((self.day,) if day_of else ())), tuple(sort_by)
        self.stats = tuple(dict.fromkeys((*stats, *sort_by, *partition_by, *((day_of,) if day_of else ()))))
        extra = [StructField(self.day, DateType())] if day_of else []
        self._stored = StructType([*self.schema.fields, *extra, StructField("write", StringType())])
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # versions and manifests

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        where = self._path(f"{self.path}/{folder}")
        if not self._fs.exists(where):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(where)]
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def version(self) -> int | None:
        """The version that was marked last."""
        return max(self._numbers("", "current-"), default=None)

    def manifest(self, version: int | None = None) -> DataFrame | None:
        """file, bytes, rows, and low_, high_, nulls_ of the ``stats`` columns; None before the first write."""
        found = self.version() if version is None else version
        return None if found is None else self.spark.read.schema(self._manifest_schema()).parquet(f"{self.path}/manifest/v={found}")

    def _manifest_schema(self) -> StructType:
        each = [f(c) for c in self.stats for f in (lambda c: StructField(f"low_{c}", self.schema[c].dataType), lambda c: StructField(f"high_{c}", self.schema[c].dataType), lambda c: StructField(f"nulls_{c}", LongType()))]
        return StructType([StructField("file", StringType()), StructField("bytes", LongType()), StructField("rows", LongType()), *each])

    def files(self) -> list[str]:
        """The files of the current version, below ``data``."""
        return [] if (found := self.manifest()) is None else self._names(found)

    def _names(self, manifest: DataFrame) -> list[str]:
        """Paths go to the driver, as they do for every scan of files; rows do not."""
        return sorted(r.file for r in manifest.select("file").collect())

    def _commit(self, manifest: DataFrame) -> None:
        version = max([*self._numbers("manifest", "v="), *self._numbers("", "current-")], default=0) + 1
        manifest.select(*self._manifest_schema().names).hint("rebalance").write.parquet(f"{self.path}/manifest/v={version}")
        self._fs.create(self._path(f"{self.path}/current-{version}"), False).close()  # fails if another writer has marked it
        self._expire(version)

    def _expire(self, version: int) -> None:
        """Versions before the last ``keep`` go, and the files that only they name."""
        marked = self._numbers("", "current-")
        old = [v for v in self._numbers("manifest", "v=") if v <= version - self.keep]
        kept = [v for v in marked if v > version - self.keep]
        if not old:
            return
        for v in old:
            self._fs.delete(self._path(f"{self.path}/current-{v}"), False)
        named = lambda vs: reduce(DataFrame.unionByName, (self.manifest(v).select("file") for v in vs))
        for r in named(old).distinct().join(named(kept), "file", "left_anti").toLocalIterator():
            self._fs.delete(self._path(f"{self.path}/data/{unquote(r.file)}"), False)
        for v in old:
            self._fs.delete(self._path(f"{self.path}/manifest/v={v}"), True)

    # data files

    def _scan(self, paths: Sequence[str]) -> DataFrame:
        """Rows of files or folders below ``data``, with the columns of the layout."""
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        where = f"{self.path}/data"
        return self.spark.read.schema(self._stored).option("basePath", where).parquet(*(f"{where}/{unquote(p)}" for p in paths))

    def _own(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names)

    def _add(self, df: DataFrame) -> tuple[str, DataFrame]:
        """Write ``df``; the write's folder, and the manifest rows of its files (by a scan of the ``stats`` columns only)."""
        rows = df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields))
        if self.day:
            rows = rows.withColumn(self.day, F.to_date(self.day_of))
        if order := [*self.partition_by, *self.sort_by]:
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        folder = f"write={uuid.uuid4().hex}"
        (rows.write.partitionBy(*self.partition_by) if self.partition_by else rows.write).parquet(f"{self.path}/data/{folder}")
        each = [f for c in self.stats for f in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))]
        by = [self._file().alias("file"), F.col("_metadata.file_size").alias("bytes")]
        return folder, self._scan([folder]).groupBy(*by).agg(F.count("*").alias("rows"), *each)

    def _file(self) -> Column:
        return F.substring_index("_metadata.file_path", "/data/", -1)

    def read(self, column: str | None = None, low=None, high=None) -> DataFrame:
        """The table, typed and empty before its first write; of ``column``, one of ``stats``, only values from ``low`` to ``high``: files beyond them are not read."""
        manifest = self.manifest()
        if manifest is None:
            return self.spark.createDataFrame([], self.schema)
        if column is None:
            return self._own(self._scan(self._names(manifest)))
        kind, value = self.schema[column].dataType, F.col(column)
        least, most = (None if x is None else F.lit(x).cast(kind) for x in (low, high))
        for bound, holds, kept in ((least, lambda c, b: c >= b, f"high_{column}"), (most, lambda c, b: c <= b, f"low_{column}")):
            if bound is not None:
                manifest = manifest.filter(holds(F.col(kept), bound))
        rows = self._scan(self._names(manifest))
        for bound, holds in ((least, lambda c, b: c >= b), (most, lambda c, b: c <= b)):
            if bound is not None:
                rows = rows.filter(holds(value, bound))
                if column == self.day_of:
                    rows = rows.filter(holds(F.col(self.day), F.to_date(bound)))
        return self._own(rows)

    # changes

    def replace(self, df: DataFrame) -> None:
        self._commit(self._add(df)[1])

    def append(self, df: DataFrame) -> None:
        found = self._add(df)[1]
        self._commit(found if (now := self.manifest()) is None else now.unionByName(found))

    def upsert(self, df: DataFrame, key: Sequence[str], newest: Sequence[str] = ()) -> list[str]:
        """Rows of ``df`` take the place of those with the same key; the files that were rewritten for it."""
        folder, found = self._add(latest(df, key, newest) if newest else df)
        now = self.manifest()
        if now is None:
            self._commit(found)
            return []
        keys = self._scan([folder]).select(*key)
        touched = self._holding(now, keys, key)
        self._rewrite(now, touched, lambda rows: rows.join(keys, list(key), "left_anti"), found)
        return touched

    def _holding(self, now: DataFrame, keys: DataFrame, key: Sequence[str]) -> list[str]:
        """Files that hold one of ``keys``: those whose range of the first key column meets one of up to ``RANGES`` ranges of the keys, by a scan of their key columns."""
        first = key[0]
        if first in self.stats:
            ranges = keys.select(first).repartitionByRange(RANGES, first).groupBy(F.spark_partition_id()).agg(F.min(first).alias("lo"), F.max(first).alias("hi"))
            now = now.join(F.broadcast(ranges.select("lo", "hi")), (F.col(f"high_{first}") >= F.col("lo")) & (F.col(f"low_{first}") <= F.col("hi")), "left_semi")
        if not (names := self._names(now)):
            return []
        return self._names(self._scan(names).select(*key, self._file().alias("file")).join(keys, list(key), "left_semi").select("file").distinct())

    def _rewrite(self, now: DataFrame, touched: Sequence[str], left: Callable[[DataFrame], DataFrame], added: DataFrame | None = None, gone: Sequence[str] = ()) -> int:
        """A version without the files ``gone`` and ``touched``, but with what ``left`` leaves of the rows of the latter; how many those are."""
        manifest, rows = now, 0
        if out := [*touched, *gone]:
            names = self.spark.createDataFrame([(f,) for f in out], "file string")
            manifest = now.join(names, "file", "left_anti")
        if touched:
            folder, kept = self._add(left(self._own(self._scan(touched))))
            kept = cut(kept, "rewritten-files")
            rows = kept.agg(F.sum("rows")).first()[0] or 0
            manifest = manifest.unionByName(kept)
        self._commit(manifest if added is None else manifest.unionByName(added))
        return rows

    def delete(self, condition: str) -> int:
        """Rows for which ``condition`` holds go; how many they were. A scan of its columns finds the files; those without such rows stay."""
        now = self.manifest()
        if now is None:
            return 0
        hit = self._scan(self._names(now)).groupBy(self._file().alias("file")).agg(F.count_if(F.expr(condition)).alias("n"), F.count("*").alias("rows")).filter("n > 0").collect()
        if hit:
            whole, part = [r.file for r in hit if r.n == r.rows], [r.file for r in hit if r.n < r.rows]
            self._rewrite(now, part, lambda rows: rows.filter(~F.coalesce(F.expr(condition), F.lit(False))), gone=whole)
        return sum(r.n for r in hit)

    def delete_before(self, column: str, cutoff) -> int:
        """Rows whose ``column``, one of ``stats``, is before ``cutoff`` go; how many they were, by the manifest: only files that hold both kinds are read."""
        now = self.manifest()
        if now is None:
            return 0
        at = F.lit(cutoff).cast(self.schema[column].dataType)
        old = now.filter(F.col(f"low_{column}") < at).select("file", "rows", ((F.col(f"high_{column}") < at) & (F.col(f"nulls_{column}") == 0)).alias("whole")).collect()
        if not old:
            return 0
        whole, part = [r.file for r in old if r.whole], [r.file for r in old if not r.whole]
        return sum(r.rows for r in old) - self._rewrite(now, part, lambda rows: rows.filter(~F.coalesce(F.col(column) < at, F.lit(False))), gone=whole)

    def replace_range(self, column: str, low, high, df: DataFrame) -> list[str]:
        """``df`` takes the place of the rows whose ``column``, one of ``stats``, is from ``low`` to ``high``, in one change; the files rewritten for it."""
        found, now, kind = self._add(df)[1], self.manifest(), self.schema[column].dataType
        if now is None:
            self._commit(found)
            return []
        least, most = F.lit(low).cast(kind), F.lit(high).cast(kind)
        inside = (F.col(f"low_{column}") >= least) & (F.col(f"high_{column}") <= most) & (F.col(f"nulls_{column}") == 0)
        old = now.filter((F.col(f"high_{column}") >= least) & (F.col(f"low_{column}") <= most)).select("file", inside.alias("inside")).collect()
        part = [r.file for r in old if not r.inside]
        self._rewrite(now, part, lambda rows: rows.filter(~F.coalesce(F.col(column).between(least, most), F.lit(False))), found, [r.file for r in old if r.inside])
        return part

    def compact(self, below: int = 32_000_000) -> int:
        """Files of fewer bytes than ``below`` are written anew together; how many they were. Appends leave such files."""
        now = self.manifest()
        small = [] if now is None else self._names(now.filter(F.col("bytes") < below))
        if len(small) > 1:
            self._rewrite(now, small, lambda rows: rows)
        return len(small) if len(small) > 1 else 0

    def truncate(self) -> None:
        self.replace(self.spark.createDataFrame([], self.schema))


def latest(rows: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Of rows with one key, the newest; partial in each task before the shuffle, so a key may be frequent."""
    order = F.struct(*newest, F.xxhash64(*rows.columns).alias("_tie"))
    return rows.groupBy(*(F.col(k).alias(f"_{k}") for k in key)).agg(F.max_by(F.struct(*rows.columns), order).alias("row")).select("row.*")


def merged(old: DataFrame, new: DataFrame, key: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """Old rows without a new one of the same key, and the new rows; of new rows with one key, the newest stays."""
    new = latest(new, key, newest) if newest else new
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new, allowMissingColumns=True)


def older_than(df: DataFrame, cutoff: str, column: str = "ingested_at") -> DataFrame:
    return df.filter(F.col(column) < F.lit(cutoff).cast(df.schema[column].dataType))


def export(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def exported_count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count()


def write_csv(df: DataFrame, path: str) -> None:
    """One file; for bounded reports."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def drop_staging(spark: SparkSession, database: str) -> list[str]:
    """Drop the tables of a staging database."""
    names = [t.name for t in spark.catalog.listTables(database)]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    return names


def introspect(df: DataFrame) -> DataFrame:
    """column_name, ordinal of a table."""
    rows = [(c, k) for k, c in enumerate(df.columns, 1)]
    return df.sparkSession.createDataFrame(rows, "column_name string, ordinal long")
