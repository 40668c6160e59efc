"""Tables in buckets: a sparse update writes only the buckets it hits."""

import os

import pytest
from pyspark.sql import functions as F

from freshet.operators.buckets import BucketedTable
from freshet.operators.materialize import materialize_counted
from freshet.session import work_path


def _table(spark, buckets=16, rows=400):
    stored = BucketedTable(work_path(spark, "buckets"), "id", buckets)
    stored.create(spark.range(rows).select(F.when(F.col("id") != 7, F.col("id")).alias("id"), F.lit("a").alias("v")))
    return stored


def _set(ids, value):
    return lambda rows: rows.withColumn("v", F.when(F.col("id").isin(*ids), F.lit(value)).otherwise(F.col("v")))


def _buckets_of(folder):
    return sorted(int(f.partition("=")[2]) for f in os.listdir(folder.removeprefix("file:")) if "=" in f)


def test_only_buckets_with_a_change_are_written(spark):
    stored = _table(spark)
    before = stored.manifest(spark)
    hit = stored.update(spark.createDataFrame([(3,), (3,), (250,), (9999,)], "id long"), _set([3, 250], "b"))
    after = stored.manifest(spark)
    assert 1 <= len(hit) <= 3 and _buckets_of(after["version"]) == hit
    assert {b for b in before if b.isdigit() and before[b] != after[b]} == {str(b) for b in hit}
    got = {r["id"]: r["v"] for r in stored.read(spark).collect()}
    assert len(got) == 400 and {i for i, v in got.items() if v == "b"} == {3, 250} and None in got
    # A second update sees the first one's.
    stored.update(spark.createDataFrame([(250,), (None,)], "id long"), _set([250], "c"))
    assert sorted(r["v"] for r in stored.read(spark).where("v <> 'a'").collect()) == ["b", "c"]


def test_a_key_that_is_not_there_changes_nothing(spark):
    stored = _table(spark, rows=1)
    before = stored.manifest(spark)
    assert stored.update(spark.range(0), _set([1], "b")) == [] and stored.manifest(spark) == before


def test_an_update_that_loses_rows_or_columns_is_not_published(spark):
    stored = _table(spark)
    before = stored.manifest(spark)
    changes = spark.range(5)
    for bad in (lambda r: r.where("id > 2"), lambda r: r.drop("v"), lambda r: r.withColumn("id", F.col("id") + 1000)):
        with pytest.raises(ValueError):
            stored.update(changes, bad)
    assert stored.manifest(spark) == before and stored.read(spark).count() == 400


def test_another_layout_is_refused_and_an_empty_table_reads_empty(spark):
    stored = _table(spark)
    with pytest.raises(ValueError):
        BucketedTable(stored.root, "id", 8).read(spark)
    with pytest.raises(ValueError):
        stored.create(spark.range(1))
    empty = _table(spark, rows=0)
    assert empty.read(spark).columns == ["id", "v"] and empty.read(spark).count() == 0
    assert empty.update(spark.range(3), _set([1], "b")) == []


def test_a_change_by_another_writer_is_noticed(spark):
    stored = _table(spark)

    def meanwhile(rows):
        stored.update(spark.range(1), _set([0], "x"))
        return rows

    with pytest.raises(RuntimeError):
        stored.update(spark.range(5), meanwhile)


def test_rows_are_counted_as_they_are_written(spark):
    for df, n in ((spark.range(1000), 1000), (spark.range(1000).groupBy(F.col("id") % 7).count(), 7), (spark.range(0), 0), (spark.range(9).where("id < 0"), 0)):
        out, counted = materialize_counted(df, "counted")
        assert counted == n == out.count()
