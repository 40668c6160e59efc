"""Reading the given parquet tables.

Only a scan is declared here; the columns a query uses and the filters it
applies reach the parquet reader through Catalyst (``ReadSchema`` and
``PushedFilters`` in the plan), so no projection is forced at read time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables to ``spark.sql`` under their own names."""
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as a catalog table bucketed and sorted by ``key``.

    Joins on ``key`` against such a table shuffle only the other side (to
    the table's bucket count), so a snapshot rewrite of a very large table
    keyed by ``key`` needs no exchange of the large table.
    """
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)
