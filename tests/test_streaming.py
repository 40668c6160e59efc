"""Streaming restarts: a second run on the same checkpoint processes only the
newly landed files and keeps the state of the first."""

import datetime as dt

from freshet.session import work_path
from freshet.streaming.status_stream import read_latest, run_latest_per_key

SCHEMA = "key long, data string, received_at timestamp_ntz, request_id long"


def _t(m):
    return dt.datetime(2024, 1, 1, 0, m)


def _run(spark, root):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/landing")
    q = run_latest_per_key(stream, ["key"], ["received_at", "request_id"], ["data"],
                           f"{root}/out", f"{root}/_checkpoint", state_partitions=3)
    q.awaitTermination()
    return q


def test_restart_processes_only_new_files(spark):
    root = work_path(spark, "stream_restart")
    spark.createDataFrame([(1, "a", _t(1), 1), (2, "b", _t(2), 2), (1, "c", _t(3), 3)], SCHEMA) \
        .coalesce(1).write.parquet(f"{root}/landing/part=1")
    _run(spark, root)
    first = {r.key: r.data for r in read_latest(spark, f"{root}/out", ["key"],
                                                ["received_at", "request_id"], ["data"]).collect()}
    assert first == {1: "c", 2: "b"}
    batches_before = spark.read.parquet(f"{root}/out").select("batch_id").distinct().count()

    # a later poll lands; it also carries a response for key 2 that was received
    # before the first run's one (landed late): arrival order decides, so it loses
    spark.createDataFrame([(2, "d", _t(4), 4), (3, "e", _t(5), 5), (2, "old", _t(0), 0)], SCHEMA) \
        .coalesce(1).write.parquet(f"{root}/landing/part=2")
    q = _run(spark, root)
    latest = {r.key: r.data for r in read_latest(spark, f"{root}/out", ["key"],
                                                 ["received_at", "request_id"], ["data"]).collect()}
    assert latest == {1: "c", 2: "d", 3: "e"}
    assert spark.read.parquet(f"{root}/out").select("batch_id").distinct().count() == batches_before + 1
    # the second run read only the new file
    assert q.recentProgress[-1]["numInputRows"] in (0, 3) and sum(p["numInputRows"] for p in q.recentProgress) == 3


def test_reads_touch_only_the_snapshot_and_later_batches(spark):
    from freshet.streaming.status_stream import files_to_read

    root = work_path(spark, "stream_compact")
    for i in range(7):
        spark.createDataFrame([(i % 3, f"v{i}", _t(i), i)], SCHEMA).coalesce(1).write.parquet(f"{root}/landing/part={i}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{root}/landing/*")
    run_latest_per_key(stream, ["key"], ["received_at", "request_id"], ["data"], f"{root}/out", f"{root}/_checkpoint",
                       state_partitions=2, compact_every=3).awaitTermination()
    snapshot, files = files_to_read(spark, f"{root}/out")
    assert snapshot.endswith("upto=5") and files and all("batch_id=6" in f for f in files)
    latest = read_latest(spark, f"{root}/out", ["key"], ["received_at", "request_id"], ["data"])
    assert {r.key: r.data for r in latest.collect()} == {0: "v6", 1: "v4", 2: "v5"}


def test_split_and_incomplete_responses(spark):
    from freshet.operators.snapshot import publish, read_current, write_version
    from freshet.sources.landing import read_landed_stream
    from freshet.streaming.status_stream import run_status_refresh

    status = spark.createDataFrame([("A", "L/A", None, None, None), ("B", "L/B", None, None, None)],
                                   "key string, location string, data string, update_status string, last_update timestamp")
    locations = status.select("location", "key")
    root = work_path(spark, "stream_split")
    publish(spark, f"{root}/status", write_version(status, f"{root}/status"))
    body = '{"current_observation":{"display_location":{"city":"A"},"weather":"Fog"}}'
    day = lambda d, m: dt.datetime(2024, 1, d, 0, m, tzinfo=dt.timezone.utc)
    polls = [
        [(1, "L/A", 200, 0, body[:20], day(1, 0), 2), (2, "L/B", 200, 0, "{", day(1, 0), 3)],
        [(1, "L/A", 200, 1, body[20:], day(1, 1), 2)],
        [(3, "L/B", 503, 0, None, day(3, 0), 1), (4, "L/A", 200, 0, '{"x"', day(3, 1), 1)],
    ]
    from freshet.sources.landing import RESPONSE_SCHEMA

    for i, rows in enumerate(polls):
        spark.createDataFrame(rows, RESPONSE_SCHEMA).coalesce(1).write.json(f"{root}/landing/poll={i}")
    stream = read_landed_stream(spark, f"{root}/landing/*", max_files_per_trigger=1)
    run_status_refresh(spark, stream, locations, f"{root}/status", f"{root}/log", f"{root}/audit", f"{root}/_checkpoint").awaitTermination()
    got = {r.key: (r.data, r.update_status) for r in read_current(spark, f"{root}/status").collect()}
    assert got == {"A": ("Fog", "Success"), "B": (None, "Failed")}
    audit = {(r.event, r.request_id) for r in spark.read.parquet(f"{root}/audit").collect()}
    assert audit == {("incomplete_response", 2), ("unparsable_body", 4)}
    assert spark.read.text(f"{root}/log").count() == 2
