"""The log as a stream: repeated runs add nothing, damaged records are set apart."""

from datetime import datetime

from pyspark.sql import functions as F

from freshet.session import work_path
from freshet.sources.response_log import write_response_log
from freshet.streaming.log_stream import run_log_stream


def _write(spark, folder, rows):
    df = spark.createDataFrame(rows, "city string, at timestamp, body string").coalesce(1)
    write_response_log(df, folder, F.col("city"), F.col("at"), F.col("body"), mode="errorifexists")


def _run(spark, root, **kw):
    for q in run_log_stream(spark, f"{root}/log", f"{root}/out", f"{root}/bad", f"{root}/ck", lateness="10 days", state_partitions=2, **kw):
        q.awaitTermination()
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    return sorted((r["city"], r["body"]) for r in read("out").collect()), read("bad").collect()


def test_a_doubled_run_adds_nothing_and_damage_is_kept_apart(spark):
    root, at = work_path(spark, "log_stream_test"), datetime(2024, 5, 1, 12)
    first = [("a", at, '{"x":1}'), ("a", at, '{"x":2}'), ("b", at, '{"x":1}')]
    _write(spark, f"{root}/log/run=0", first)
    _write(spark, f"{root}/log/run=1", [("c", at, '{"x":'), ("d", at, "[1]"), ("e", at, "null"), ("f", at, "")])
    good, bad = _run(spark, root)
    assert good == [("a", '{"x":1}'), ("a", '{"x":2}'), ("b", '{"x":1}')]
    assert sorted(r["city"] for r in bad) == ["c", "d", "e", "f"] and all("run=1" in r["file"] for r in bad)
    # Later: the first run again, whole, with one record more and a header that is none.
    _write(spark, f"{root}/log/run=2", [*first, ("c", at, '{"x":3}')])
    spark.createDataFrame([("no header at all\n{}",)], "value string").coalesce(1).write.text(f"{root}/log/run=3")
    good, bad = _run(spark, root, max_files_per_trigger=1)
    assert good == [("a", '{"x":1}'), ("a", '{"x":2}'), ("b", '{"x":1}'), ("c", '{"x":3}')]
    assert len(bad) == 5 and sum(r["city"] is None for r in bad) == 1
