"""Global ordinals and running sums without a single-task window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one
task. The functions here compute the same numbers in two passes that stay
parallel:

1. ``repartitionByRange`` deals the rows to ranges of the ordering key, and
   the result is written to the shared folder together with the range's
   number (``spark_partition_id``). Spark's sort order rules throughout, so
   NULL, NaN and infinite keys, strings and composite keys need no case of
   their own, and the number of ranges is only bounded by the cluster.
2. In one query over what was written: the total of each range (a partial
   aggregate, one row per range), the running total of the ranges before it
   (a window over those rows, then broadcast: as many rows as we asked for
   ranges), and the running value inside the range (a window partitioned by
   range). The answer is offset + value inside.

The range of a row is read from the written file, so both branches agree on
it and a retried task cannot deal a row elsewhere. The ordering must be
unique for the numbers to be deterministic; callers pass a key that is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.operators.materialize import materialize

RANGES_PER_PARTITION = 4  # ranges are hashed to tasks again; more of them even that out


def default_buckets(df: DataFrame) -> int:
    return RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_total(
    df: DataFrame,
    order_cols: Sequence[str],
    value: Column | None = None,
    out: str = "rnum",
    inclusive: bool = True,
    n_buckets: int | None = None,
) -> DataFrame:
    """Add ``out`` = running sum of ``value`` (default 1) in ``order_cols`` order.

    With ``value=None`` and ``inclusive=True`` this is ``row_number()`` over
    the whole table. ``inclusive=False`` excludes the current row (the frame
    ``rowsBetween(unboundedPreceding, -1)``), 0 for the first row.
    ``df`` is read twice (Spark samples the range bounds first), so stage it
    if it is expensive.
    """
    order_cols = list(order_cols)
    val = F.lit(1).cast("long") if value is None else value
    ranged = df.withColumn("_val", val).repartitionByRange(n_buckets or default_buckets(df), *order_cols)
    tagged = materialize(ranged.withColumn("_bkt", F.spark_partition_id()), "ordinal")

    totals = tagged.groupBy("_bkt").agg(F.sum("_val").alias("_bsum"))
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bkt", F.coalesce(F.sum("_bsum").over(before), F.lit(0)).alias("_boff")
    )

    frame = Window.partitionBy("_bkt").orderBy(*order_cols)
    if value is None:
        within = F.row_number().over(frame).cast("long")
        if not inclusive:
            within = within - 1
    else:
        upto = 0 if inclusive else -1
        within = F.coalesce(
            F.sum("_val").over(frame.rowsBetween(Window.unboundedPreceding, upto)), F.lit(0)
        )

    numbered = tagged.withColumn("_within", within)
    joined = numbered.join(F.broadcast(offsets), "_bkt")  # at most n_buckets rows
    return joined.select(*[F.col(c) for c in df.columns], (F.col("_boff") + F.col("_within")).alias(out))


def global_row_number(
    df: DataFrame,
    order_cols: Sequence[str],
    out: str = "rnum",
    n_buckets: int | None = None,
) -> DataFrame:
    """``row_number() over (order by order_cols)`` computed in parallel."""
    return running_total(df, order_cols, None, out, True, n_buckets)
