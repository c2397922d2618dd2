"""The session that the library expects: UTC, adaptive execution."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: HotSpot's own limit; beyond it a method is never compiled.
METHOD_BYTES = 8_000

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once a Spark application, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="brightwire-")) / "brightwire.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(here.rglob("*.py")):
            z.write(path, path.relative_to(here.parent))
    context.addPyFile(str(target))


def limit_methods(spark: SparkSession) -> None:
    """Stages whose generated method is larger than what HotSpot compiles run as the operators' own, smaller methods instead of being interpreted."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > METHOD_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))


def build_session(app: str = "brightwire", **conf: str) -> SparkSession:
    """Shuffle partitions, memory and master are left to the cluster's own settings; ``conf`` adds to them."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
