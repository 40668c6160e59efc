"""Small pieces the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.sources.tables import load


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null keys go to fold 0."""
    return F.coalesce(F.crc32(key.cast("string")) % F.lit(folds), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; other columns never enter an operator."""
    return load(spark, sf_dir, name).select(*columns)


def map_texts(
    df: DataFrame,
    factory: Callable[[], Callable[[list], tuple]],
    new: dict[str, tuple[str, pa.DataType]],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with columns computed from its column ``text``, batch by batch.

    ``factory`` runs once in each task and gives a function from a list of
    texts (None for null) to one list per column of ``new`` (name to Spark and
    Arrow type). Columns of these names and of ``drop`` are left out; all others
    pass as they are, without a detour through pandas.
    """
    keep = [f for f in df.schema.fields if f.name not in new and f.name not in drop]
    names = [*(f.name for f in keep), *new]
    types = [t for _, t in new.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = factory()
        for b in batches:
            made = make(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(v, t) for v, t in zip(made, types))], names=names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), *(f"`{n}` {t}" for n, (t, _) in new.items())])
    return df.select(*[F.col(f"`{f.name}`") for f in keep], F.col("text").alias("__text")).mapInArrow(run, schema)


def popcount(x):
    """Set bits of each unsigned 64-bit number of an array."""
    import numpy as np

    return np.bitwise_count(x)
