"""A global ordinal that is kept up to date as rows are added.

The rows lie in ranges of the ordering, one folder each, with their number inside
the range. An index of one row per range says where it starts (its least key), how
many rows it has and which folder holds it. A row's ordinal is the rows of the
ranges before its own plus its number inside, so what moves when rows are added is
an offset in the index; the files of a range without a new row stay as they are and
are not read.

Adding rows: the range of a new row is the last one that starts at or before it,
a running fold over the index and the new rows together (rows before the first range
join that). Ranges that get rows are read, merged and dealt anew; neighbours among
them make one run, cut into equal pieces of at most ``capacity`` rows. A run's numbers
come from the two-pass ordinal, so rows that all fall into one range (a log that only
grows at its end) are no single task.

The ordering must be unique over all rows ever added; it is Spark's ascending order
(NULL first). Driver and index hold at most one row per range: choose ``capacity`` so
that a range is a few files. One writer per table; a writer that finds another index
current than the one it read fails, and a run that dies leaves the old one current.
Columns whose names start with two underscores are reserved.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from freshet.operators.materialize import materialize
from freshet.operators.ordinal import running_total
from freshet.operators.scan import LAST, running_fold
from freshet.operators.snapshot import newest_manifest, publish_all

RANGE, WITHIN = "__range", "__within"
_FOLDER = "__folder"
# Names in the manifest: the index, and a file without rows that has the columns.
_INDEX, _COLUMNS = "index", "columns"


def _before(value: str | Column, *order: str) -> Column:
    """Sum of ``value`` over the earlier rows of the index, 0 for the first."""
    rows = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0)).cast("long")


@dataclass(frozen=True)
class StoredOrdinal:
    root: str
    order: tuple[str, ...]
    capacity: int = 1_000_000

    def index(self, spark: SparkSession) -> DataFrame:
        """(__range, path, n, low) of the current ranges; ``low`` is a struct of
        the ordering."""
        return spark.read.parquet(self._current(spark)[_INDEX])

    def create(self, rows: DataFrame) -> None:
        spark = rows.sparkSession
        if newest_manifest(spark, self.root):
            raise ValueError(f"{self.root} has an index already")
        if reserved := [c for c in rows.columns if c.startswith("__")]:
            raise ValueError(f"reserved column names: {reserved}")
        columns = f"{self.root}/{_COLUMNS}-{uuid.uuid4().hex}"
        spark.createDataFrame([], rows.schema).coalesce(1).write.parquet(columns)
        self._publish(spark, self._one_run(materialize(rows, "ordinal_rows")), {_COLUMNS: columns})

    def add(self, rows: DataFrame) -> list[int]:
        """Add ``rows`` (the table's columns); the ranges that were dealt anew."""
        spark = rows.sparkSession
        now = self._current(spark)
        index, schema = spark.read.parquet(now[_INDEX]), spark.read.parquet(now[_COLUMNS]).schema
        columns = [F.col(f"`{c}`") for c in schema.names]
        rows = self._located(rows.select(*columns), index)
        if rows.isEmpty():
            return []
        if index.isEmpty():
            self._publish(spark, self._one_run(rows.drop(RANGE)), now)
            return []

        # Over the index alone: windows of one row per range.
        added = rows.groupBy(RANGE).agg(F.count("*").alias("__new"))
        ranges = index.join(added, RANGE, "left").withColumn("__hit", F.col("__new").isNotNull())
        runs = ranges.withColumn("__run", _before(F.when(F.col("__hit"), 0).otherwise(1), "low")).where("__hit")
        sizes = runs.groupBy("__run").agg(F.sum(F.col("n") + F.col("__new")).alias("__rows"))
        sizes = sizes.withColumn("__pieces", F.ceil(F.col("__rows") / self.capacity).cast("long"))
        top = index.agg(F.max(RANGE)).first()[0] + 1
        sizes = sizes.select("*", _before("__rows", "__run").alias("__start"), (_before("__pieces", "__run") + top).alias("__first"))
        plan = materialize(runs.select(RANGE, "path", "__run").join(sizes, "__run"), "ordinal_plan")

        hit = {r[RANGE]: r["path"] for r in plan.select(RANGE, "path").collect()}  # at most one row per range
        old = self._read(spark, [*hit.values()], schema)
        merged = old.select(*columns, RANGE).unionByName(rows).join(plan.drop("path", "__run"), RANGE)
        fresh = self._file(merged.drop(RANGE), schema.names)
        kept = index.join(plan.select(RANGE), RANGE, "left_anti")
        self._publish(spark, kept.unionByName(fresh), now)
        return sorted(hit)

    def read(self, spark: SparkSession, out: str = "rnum", first: int | None = None, last: int | None = None) -> DataFrame:
        """The rows with their ordinal from 1; with ``first`` or ``last`` only those
        numbers, from the ranges that hold them."""
        now = self._current(spark)
        starts = spark.read.parquet(now[_INDEX]).select(RANGE, "path", "n", _before("n", "low").alias("__before"))
        if first is not None:
            starts = starts.where(F.col("__before") + F.col("n") >= first)
        if last is not None:
            starts = starts.where(F.col("__before") < last)
        paths = [r["path"] for r in starts.select("path").collect()]  # at most one row per range
        schema = spark.read.parquet(now[_COLUMNS]).schema
        rows = self._read(spark, paths, schema).join(starts.select(RANGE, "__before"), RANGE)
        found = rows.select(*[F.col(f"`{c}`") for c in schema.names], (F.col("__before") + F.col(WITHIN)).alias(out))
        if first is not None:
            found = found.where(F.col(out) >= first)
        return found if last is None else found.where(F.col(out) <= last)

    def _read(self, spark: SparkSession, paths: list[str], columns: StructType) -> DataFrame:
        schema = StructType([*columns.fields, StructField(RANGE, LongType()), StructField(WITHIN, LongType())])
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _current(self, spark: SparkSession) -> dict[str, str]:
        found = newest_manifest(spark, self.root)
        if not found:
            raise ValueError(f"{self.root} has no index")
        return found

    def _located(self, rows: DataFrame, index: DataFrame) -> DataFrame:
        """``rows`` with the range each belongs to, written."""
        starts = index.select(*[F.col(f"low.`{c}`").alias(c) for c in self.order], F.lit(0).alias("__kind"), F.col(RANGE))
        both = rows.withColumn("__kind", F.lit(1)).unionByName(starts, allowMissingColumns=True)
        found = running_fold(both, [*self.order, "__kind"], F.col(RANGE), LAST, "__at")
        first = index.agg(F.min_by(RANGE, "low")).first()[0]
        at = F.coalesce("__at", F.lit(first).cast("long"))
        return materialize(found.where("__kind = 1").withColumn(RANGE, at).drop("__kind", "__at"), "ordinal_new")

    def _one_run(self, rows: DataFrame) -> DataFrame:
        """File all ``rows``, written ones, as the table's only run."""
        n = rows.count()
        run = {"__start": 0, "__rows": n, "__pieces": -(-n // self.capacity), "__first": 0}
        return self._file(rows.select("*", *[F.lit(v).cast("long").alias(c) for c, v in run.items()]), rows.columns)

    def _file(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Write ``rows`` as ranges: with them come their run's ordinal before its first
        row, rows, pieces and first range. The ranges' rows for the index."""
        spark = rows.sparkSession
        path = f"{self.root}/v={uuid.uuid4().hex}"
        numbered = running_total(rows, ["__start", *self.order], out="__ord")
        numbered = numbered.withColumn("__at", F.col("__ord") - F.col("__start") - 1)
        numbered = numbered.withColumn("__piece", F.expr("(__at * __pieces) div __rows"))
        begin = F.expr("(__piece * __rows + __pieces - 1) div __pieces")  # the piece's first row
        filed = numbered.select(
            *[F.col(f"`{c}`") for c in columns], (F.col("__first") + F.col("__piece")).alias(RANGE),
            (F.col("__at") - begin + 1).alias(WITHIN), (F.col("__first") + F.col("__piece")).alias(_FOLDER))
        # Spark puts small ranges together and splits large ones, one shuffle of what is written.
        filed.hint("rebalance", F.col(_FOLDER)).write.mode("errorifexists").partitionBy(_FOLDER).parquet(path)
        stored = spark.read.schema(filed.drop(_FOLDER).schema).parquet(path)
        low = F.min(F.struct(*[F.col(f"`{c}`") for c in self.order])).alias("low")
        return stored.groupBy(RANGE).agg(F.count("*").alias("n"), low).select(
            RANGE, F.concat(F.lit(f"{path}/{_FOLDER}="), F.col(RANGE).cast("string")).alias("path"), "n", "low")

    def _publish(self, spark: SparkSession, index: DataFrame, now: dict[str, str]) -> None:
        path = f"{self.root}/{_INDEX}-{uuid.uuid4().hex}"
        index.coalesce(1).write.parquet(path)
        publish_all(spark, self.root, now | {_INDEX: path}, {_INDEX: now.get(_INDEX)})


def stored_row_number(parts: Sequence[DataFrame], root: str, order: Sequence[str], capacity: int, out: str = "rnum") -> DataFrame:
    """``row_number() over (order by order)`` of the union of ``parts``: the first is
    stored, each further one added."""
    stored = StoredOrdinal(root, tuple(order), capacity)
    stored.create(parts[0])
    for part in parts[1:]:
        stored.add(part)
    return stored.read(parts[0].sparkSession, out)
