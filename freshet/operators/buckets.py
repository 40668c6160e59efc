"""Tables in hash buckets, updated without rewriting what does not change.

Rows are filed by a hash of their key into a fixed number of buckets. The table's
manifest names one folder for each bucket that has rows. An update reads the buckets
that hold a key to change, writes these anew and appends a manifest that names the
new folders and, for every other bucket, the old one. A sparse update therefore
costs the buckets it hits; a run that dies leaves the old manifest current.

Choose the number of buckets so that one is a few files. One writer per table; a
writer that finds another version current than the one it read fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.snapshot import newest_manifest, publish_all

BUCKET = "__bucket"
# Further names in the manifest: the newest version's folder, a file without rows
# that has the columns, and the layout.
_VERSION, _COLUMNS, _LAYOUT = "version", "columns", "layout"


@dataclass(frozen=True)
class BucketedTable:
    root: str
    key: str
    buckets: int

    @property
    def _layout(self) -> str:
        return f"{self.key}/{self.buckets}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{self.key}`")), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> tuple[str, dict[int, int]]:
        """Folder of the new version and the rows in each of its buckets."""
        path = f"{self.root}/v={uuid.uuid4().hex}"
        # Spark puts small buckets together and splits large ones, one shuffle of what is written.
        filed = rows.withColumn(BUCKET, self._bucket()).hint("rebalance", F.col(BUCKET))
        filed.write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
        return path, _counts(rows.sparkSession, [path], self._bucket(), rows.schema)

    def manifest(self, spark: SparkSession) -> dict[str, str]:
        found = newest_manifest(spark, self.root)
        if found and found[_LAYOUT] != self._layout:
            raise ValueError(f"{self.root} is filed as {found[_LAYOUT]}, not as {self._layout}")
        return found

    def create(self, rows: DataFrame) -> None:
        spark = rows.sparkSession
        if self.manifest(spark):
            raise ValueError(f"{self.root} has a version already")
        columns = f"{self.root}/columns-{uuid.uuid4().hex}"
        spark.createDataFrame([], rows.schema).coalesce(1).write.parquet(columns)
        path, counts = self._write(rows)
        folders = {str(b): f"{path}/{BUCKET}={b}" for b in counts}
        publish_all(spark, self.root, folders | {_VERSION: path, _COLUMNS: columns, _LAYOUT: self._layout})

    def read(self, spark: SparkSession, only: set[int] | None = None) -> DataFrame:
        """The current rows, or those of some buckets."""
        now = self.manifest(spark)
        return self._of(spark, now, only)

    def _of(self, spark: SparkSession, now: dict[str, str], only: set[int] | None) -> DataFrame:
        schema = spark.read.parquet(now[_COLUMNS]).schema
        paths = [p for b, p in now.items() if b.isdigit() and (only is None or int(b) in only)]
        return spark.read.schema(schema).parquet(now[_COLUMNS], *paths)

    def update(self, changes: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Apply ``change`` to the rows of the buckets that hold a key of ``changes``
        (column ``key``); the buckets that were written. ``change`` keeps every
        row, its key and the columns; otherwise nothing is published."""
        spark = changes.sparkSession
        now = self.manifest(spark)
        # At most one row per bucket.
        asked = {r[0] for r in changes.select(self._bucket()).distinct().collect()}
        hit = sorted(b for b in asked if str(b) in now)
        if not hit:
            return []
        rows = self._of(spark, now, set(hit))
        new = change(rows)
        shape = lambda df: [(f.name, f.dataType) for f in df.schema.fields]
        if shape(new) != shape(rows):
            raise ValueError("the update changes the columns")
        path, counts = self._write(new)
        if counts != _counts(spark, [now[str(b)] for b in hit], self._bucket(), rows.schema):
            raise ValueError("the update changes keys or the number of rows")
        folders = {str(b): f"{path}/{BUCKET}={b}" for b in hit}
        publish_all(spark, self.root, now | folders | {_VERSION: path}, {_VERSION: now[_VERSION]})
        return hit


def _counts(spark: SparkSession, paths: list[str], bucket: Column, schema) -> dict[int, int]:
    """Rows in each bucket of what was written (at most one row per bucket)."""
    rows = spark.read.schema(schema).parquet(*paths)
    return {r["b"]: r["n"] for r in rows.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()}
