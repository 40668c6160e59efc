"""Latest row per key.

``max_by(values, ordering)`` is a partial aggregate: each map task keeps one
buffer row per key and only those cross the shuffle, so a key holding a
third of all rows costs one buffer row per task, not a third of the data in
one task. Rows whose ordering is NULL are skipped, which is how the
conditional variants below select among a subset of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_value(values: Sequence, ordering: Sequence, where: Column | None = None) -> Column:
    """Aggregate: struct of ``values`` from the row with the greatest ``ordering``."""
    order = F.struct(*[_as_col(c) for c in ordering])
    if where is not None:
        order = F.when(where, order)
    return F.max_by(F.struct(*[_as_col(c) for c in values]), order)


def latest_by_key(df: DataFrame, keys: Sequence[str], ordering: Sequence, values: Sequence[str]) -> DataFrame:
    """One row per key with the ``values`` of its latest row."""
    agg = df.groupBy(*keys).agg(latest_value(values, ordering).alias("_latest"))
    return agg.select(*keys, *[F.col(f"_latest.{v}").alias(v) for v in values])
