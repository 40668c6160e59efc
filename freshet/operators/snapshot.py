"""Updates as new table snapshots, published behind a gate.

There is no transactional table format here, so an update never rewrites
the files it reads (overwriting the path being read fails mid-job).
Instead each run writes a fresh version directory with Spark's commit
protocol (a lost executor leaves no visible partial output), checks a gate
on what was written, and only then appends a manifest naming the new
version of every table of the run. The manifest is one file, so a run that
dies leaves all tables at their old versions or all at the new ones.
Readers resolve the newest manifest.

Writers: one per root at a time. Manifests are numbered upwards from the
newest one there is, so a clock that runs behind does not hide a run; with
``base`` given, a writer that finds another version current than the one it
read fails instead of losing the other's update.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER_DIR = "_published"
_MANIFEST = "table string, version string"
_PARTITION = re.compile(r"published_ms=(\d+)")
ITSELF = ""  # the table name of a manifest below the table's own root


def write_version(df: DataFrame, table_root: str) -> str:
    path = f"{table_root.rstrip('/')}/v={uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return path


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifests below ``path``; None only if the folder does not exist."""
    try:
        return spark.read.schema(_MANIFEST).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _stamps(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests below ``root``, newest first (a listing)."""
    found = _read(spark, f"{root}/{POINTER_DIR}")
    files = found.inputFiles() if found is not None else []
    return sorted({int(m.group(1)) for f in files if (m := _PARTITION.search(f))}, reverse=True)


def publish_all(spark: SparkSession, root: str, versions: Mapping[str, str],
                base: Mapping[str, str | None] | None = None) -> None:
    """Append one manifest that makes ``versions`` (table name below ``root``
    -> path) current."""
    root = root.rstrip("/")
    for name, was in (base or {}).items():
        now = current_version(spark, f"{root}/{name}" if name else root)
        if now != was:
            raise RuntimeError(f"{name or root} changed meanwhile: {was} was read, {now} is current")
    stamp = max([int(time.time() * 1000), *(s + 1 for s in _stamps(spark, root)[:1])])
    rows = spark.createDataFrame([*versions.items()], _MANIFEST).coalesce(1)
    rows.withColumn("published_ms", F.lit(stamp)).write.mode("append").partitionBy("published_ms").parquet(
        f"{root}/{POINTER_DIR}"
    )


def publish(spark: SparkSession, table_root: str, version_path: str, base: str | None = None,
            check_base: bool = False) -> None:
    """Make ``version_path`` the current version of one table."""
    publish_all(spark, table_root, {ITSELF: version_path}, {ITSELF: base} if check_base else None)


def _newest(spark: SparkSession, root: str, name: str) -> tuple[int, str] | None:
    """Newest manifest below ``root`` that names the table; only manifests
    from the newest backwards are read."""
    for stamp in _stamps(spark, root):
        row = _read(spark, f"{root}/{POINTER_DIR}/published_ms={stamp}").where(F.col("table") == name).first()
        if row:
            return stamp, row["version"]
    return None


def newest_manifest(spark: SparkSession, root: str) -> dict[str, str]:
    """What the newest manifest below ``root`` names; nothing if there is none."""
    root = root.rstrip("/")
    for stamp in _stamps(spark, root)[:1]:
        rows = _read(spark, f"{root}/{POINTER_DIR}/published_ms={stamp}").collect()
        return {r["table"]: r["version"] for r in rows}
    return {}


def current_version(spark: SparkSession, table_root: str) -> str | None:
    """Path of the newest published version: named by the table's own manifests
    or by those of the run it belongs to (the folder above)."""
    table_root = table_root.rstrip("/")
    above, _, name = table_root.rpartition("/")
    found = [n for n in (_newest(spark, table_root, ITSELF), _newest(spark, above, name)) if n]
    return max(found)[1] if found else None


def read_current(spark: SparkSession, table_root: str) -> DataFrame | None:
    path = current_version(spark, table_root)
    return spark.read.parquet(path) if path else None


def same_table(written: DataFrame, source: DataFrame) -> bool:
    """Same columns and types in the same order, and as many rows."""
    shape = lambda df: [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return shape(written) == shape(source) and written.count() == source.count()


def publish_if(
    spark: SparkSession,
    df: DataFrame,
    table_root: str,
    gate: Callable[[DataFrame], bool],
) -> tuple[bool, str]:
    """Write ``df`` as a new version; publish it only if ``gate(written)`` holds.

    Returns (published, version path). The gate sees the written files, so
    it checks what readers would get, not a recomputation.
    """
    path = write_version(df, table_root)
    written = spark.read.parquet(path)
    ok = bool(gate(written))
    if ok:
        publish(spark, table_root, path)
    return ok, path
