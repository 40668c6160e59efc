"""Running folds over an ordering without a single-task window.

The ordinal's two passes, for any associative fold: rows are dealt to ranges of
the ordering and written with the range's number; each range's own total is one
row; what lies before a range is a fold over those rows (as many as ranges were
asked for); a row's value is that, joined with the fold inside its range.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.operators.materialize import materialize
from freshet.operators.ordinal import default_buckets


@dataclass(frozen=True)
class Fold:
    """An associative operation on values where NULL is its neutral element.

    ``running`` folds a column over a window frame, ``total`` a whole range (a
    partial aggregate; it is given the value and the ordering), ``join`` two
    folded values, the earlier first, neither of them NULL.
    """

    running: Callable[[Column], Column]
    total: Callable[[Column, Column], Column]
    join: Callable[[Column, Column], Column]


SUM = Fold(F.sum, lambda v, order: F.sum(v), lambda a, b: a + b)
MAX = Fold(F.max, lambda v, order: F.max(v), F.greatest)
MIN = Fold(F.min, lambda v, order: F.min(v), F.least)
LAST = Fold(lambda v: F.last(v, ignorenulls=True), lambda v, order: F.max_by(v, F.when(v.isNotNull(), order)), lambda a, b: b)
FIRST = Fold(lambda v: F.first(v, ignorenulls=True), lambda v, order: F.min_by(v, F.when(v.isNotNull(), order)), lambda a, b: a)


def running_fold(
    df: DataFrame,
    order_cols: Sequence[str],
    value: Column,
    fold: Fold,
    out: str,
    inclusive: bool = True,
    n_buckets: int | None = None,
) -> DataFrame:
    """Add ``out``: the ``fold`` of ``value`` over all rows up to this one in the
    order of ``order_cols`` (without this one if not ``inclusive``); NULL where
    there was no value yet. The ordering must be unique. ``df`` is read twice.
    """
    order_cols = list(order_cols)
    ranged = df.withColumn("_val", value).repartitionByRange(n_buckets or default_buckets(df), *order_cols)
    tagged = materialize(ranged.withColumn("_bkt", F.spark_partition_id()), "scan")

    totals = tagged.groupBy("_bkt").agg(fold.total(F.col("_val"), F.struct(*order_cols)).alias("_total"))
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select("_bkt", fold.running(F.col("_total")).over(before).alias("_before"))

    frame = Window.partitionBy("_bkt").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    joined = tagged.withColumn("_within", fold.running(F.col("_val")).over(frame)).join(F.broadcast(earlier), "_bkt")  # at most n_buckets rows
    a, b = F.col("_before"), F.col("_within")
    value_here = F.when(a.isNull(), b).when(b.isNull(), a).otherwise(fold.join(a, b))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], value_here.alias(out))
