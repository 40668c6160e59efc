"""Structured Streaming forms of the status refresh.

Both queries read a landing directory and run with ``availableNow`` (the
on-demand refresh of the original: process everything landed, then stop)
or any other trigger. Sinks are ``foreachBatch`` writers addressed by the
batch id, so a retried batch overwrites its own output instead of
appending a second copy (exactly-once results on an at-least-once engine).
State lives in the checkpoint folder below ``spark.checkpoint.dir``.

The original has no watermark or window: the last response to arrive wins
whatever its observation time. Arrival is ``received_at``, then
``request_id``, in both streams and whatever batch a response is read in.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.jobs import refresh_and_publish
from freshet.operators.latest import latest_by_key, latest_value
from freshet.operators.materialize import materialize
from freshet.operators.snapshot import current_version, publish
from freshet.plans import weather
from freshet.sources.landing import RESPONSE_SCHEMA


def run_latest_per_key(
    stream: DataFrame,
    keys: Sequence[str],
    ordering: Sequence[str],
    values: Sequence[str],
    out_dir: str,
    checkpoint: str,
    available_now: bool = True,
    state_partitions: int | None = None,
    interval: str = "1 minute",
    compact_every: int = 100,
):
    """Maintain the latest row per key; each batch writes the keys it changed.

    Every ``compact_every`` batches the outputs so far are folded into one
    snapshot, so a reader's work does not grow with the stream's age.

    Output mode ``update`` emits only keys touched in the batch, so a batch
    costs its own size plus state lookups, not a rewrite of all keys.
    ``state_partitions`` fixes the number of state store partitions, which a
    stream keeps for its whole life (it is recorded in the checkpoint); by
    default the session's ``spark.sql.shuffle.partitions`` applies.
    """
    carried = list(values) + [o for o in ordering if o not in values]
    agg = stream.groupBy(*keys).agg(latest_value(carried, ordering).alias("_latest"))
    flat = agg.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in carried])

    spark = stream.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(spark, out_dir, keys, ordering, values, batch_id)

    writer = (
        flat.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    return _start(_triggered(writer, available_now, interval), spark, state_partitions)


def _triggered(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def _start(writer, spark: SparkSession, state_partitions: int | None):
    """Start a query; the stream keeps the partition count it starts with."""
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()  # the stream clones the session conf here
    finally:
        spark.conf.set(key, before)


_BATCH = re.compile(r"batch_id=(\d+)")


def newest_fold(spark: SparkSession, out_dir: str) -> tuple[str | None, int]:
    """Path of the newest published snapshot and the last batch it holds."""
    path = current_version(spark, f"{out_dir}_snapshots")
    return (path, int(re.search(r"upto=(\d+)", path).group(1))) if path else (None, -1)


def batch_paths(spark: SparkSession, out_dir: str, after: int) -> list[str]:
    """Folders of the batches after ``after``; only their names are listed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_dir)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = [(int(m.group(1)), s.getPath().toString()) for s in files.listStatus(path) if (m := _BATCH.search(s.getPath().getName()))]
    return [p for n, p in sorted(found) if n > after]


def files_to_read(spark: SparkSession, out_dir: str) -> tuple[str | None, list[str]]:
    """The newest snapshot and the folders of the batches after it."""
    path, upto = newest_fold(spark, out_dir)
    return path, batch_paths(spark, out_dir, upto)


def read_latest(spark: SparkSession, out_dir: str, keys: Sequence[str], ordering: Sequence[str],
                values: Sequence[str]) -> DataFrame:
    """The current latest row per key: the newest snapshot and the batches
    after it, folded."""
    carried = list(values) + [o for o in ordering if o not in values]
    path, files = files_to_read(spark, out_dir)
    parts = [spark.read.parquet(*p).select(*keys, *carried) for p in ([path] if path else [], files) if p]
    return latest_by_key(reduce(DataFrame.unionByName, parts), keys, ordering, carried)


def compact(spark: SparkSession, out_dir: str, keys: Sequence[str], ordering: Sequence[str],
            values: Sequence[str], batch_id: int) -> None:
    """Publish a snapshot of all batches up to ``batch_id``. A repeated batch
    publishes the same content again."""
    fold_outputs(spark, out_dir, batch_id, lambda: read_latest(spark, out_dir, keys, ordering, values))


def fold_outputs(spark: SparkSession, out_dir: str, batch_id: int, read: Callable[[], DataFrame]) -> None:
    """Publish what ``read`` gives as the snapshot of all batches so far."""
    if newest_fold(spark, out_dir)[1] >= batch_id:
        return
    path = f"{out_dir}_snapshots/upto={batch_id}"
    read().write.mode("overwrite").parquet(path)
    publish(spark, f"{out_dir}_snapshots", path)


def _responses(chunks: DataFrame) -> DataFrame:
    """Bodies as ``weather.parsed_bodies`` gives them, of whole responses and of those
    still ``waiting`` for chunks; the latter keep their ``chunks`` instead. ``newest``
    is the request's last arrival. The text is shuffled once: what is counted per
    request stays where the chunks were dealt. Chunks without a request wait for
    nothing and are dealt by what else they are put together by."""
    dealt = chunks.withColumn("_home", F.coalesce("request_id", F.xxhash64("location", "status"))).repartition("_home")
    joined = lambda lists: F.flatten(F.collect_list(lists))
    bodies = weather.response_bodies(dealt, ["_home"], {
        "_seqs": (F.collect_set("seq"), joined),
        "_want": (F.max("n_chunks"), F.max),
        "chunks": (F.collect_list(F.struct("seq", "chunk", "received_at", "n_chunks")), joined),
    })
    request = Window.partitionBy("_home", "request_id")
    have, want = F.size(F.array_distinct(F.flatten(F.collect_list("_seqs").over(request)))), F.max("_want").over(request)
    waiting = F.coalesce(F.col("request_id").isNotNull() & (have < want), F.lit(False))
    marked = bodies.withColumns({"waiting": waiting, "newest": F.max("received_at").over(request)}).drop("_home", "_seqs", "_want")
    return weather.with_payload(marked.withColumns({"body": F.when(~F.col("waiting"), F.col("body")), "chunks": F.when(F.col("waiting"), F.col("chunks"))}))


def run_status_refresh(
    spark: SparkSession,
    responses: DataFrame,
    locations: DataFrame,
    status_root: str,
    log_dir: str,
    audit_dir: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "1 minute",
    give_up_after: str = "1 day",
):
    """Per micro-batch: keyed update of the current status snapshot, publish a
    new version behind the gate, write the batch's log records and audit.

    A response whose chunks land in several batches waits (in a folder beside
    the checkpoint, one table per batch) until all ``n_chunks`` are there. One
    that is ``give_up_after`` older than the newest response of a batch goes
    to the audit instead, so nothing waits for ever. Every output is addressed
    by the batch id and the status only takes later arrivals, so a repeated
    batch changes nothing.
    """
    pending = f"{checkpoint.rstrip('/')}_pending"

    def step(batch: DataFrame, batch_id: int) -> None:
        chunks = batch.select(*RESPONSE_SCHEMA.fieldNames())
        if batch_id:
            chunks = chunks.unionByName(spark.read.schema(RESPONSE_SCHEMA).parquet(f"{pending}/batch_id={batch_id - 1}"))
        responses = materialize(_responses(chunks), "responses")
        newest = responses.agg(F.max("received_at").alias("t")).first()["t"]
        old = F.coalesce(F.col("newest") < F.lit(newest).cast("timestamp") - F.expr(f"interval {give_up_after}"), F.lit(False))
        waiting = responses.filter("waiting")
        waiting.filter(~old).select("request_id", "location", "status", F.inline("chunks")).select(*RESPONSE_SCHEMA.fieldNames()) \
            .write.mode("overwrite").parquet(f"{pending}/batch_id={batch_id}")
        aged = waiting.filter(old).groupBy("request_id").agg(F.max("location").alias("location"), F.max("received_at").alias("received_at"))
        lost = aged.select(F.lit("incomplete_response").alias("event"), "request_id", "location", "received_at")
        parsed = responses.filter("NOT waiting").drop("waiting", "newest", "chunks")
        res = refresh_and_publish(spark, status_root, parsed, locations, f"{log_dir}/batch_id={batch_id}", f"{audit_dir}/batch_id={batch_id}", lost)
        if not res.published:
            raise RuntimeError(f"the gate rejected the status of batch {batch_id}; the previous version stays")

    writer = responses.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, interval).start()
