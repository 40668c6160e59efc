"""Requests that never got an answer.

A poll that lands no row at all (the poller died, the file was lost) leaves no
trace in the responses; only the list of polls shows it. The two streams meet in an
outer join bounded in time, so the state holds what is younger than the limit and
the lateness, not the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.session import ROCKSDB
from freshet.streaming.state_stream import _started_with
from freshet.streaming.status_stream import _triggered


def unanswered(polls: DataFrame, responses: DataFrame, limit: str, lateness: str) -> DataFrame:
    """Streamed polls (request_id, location, polled_at) without any response
    (request_id, received_at) within ``limit``. A poll is reported once, when both
    streams are ``lateness`` past its limit; a response after the limit comes too
    late to count, and takes nothing back."""
    asked = polls.select("request_id", "location", "polled_at").withWatermark("polled_at", lateness)
    got = responses.select(F.col("request_id").alias("_id"), "received_at").withWatermark("received_at", lateness)
    in_time = F.expr(f"request_id = _id AND received_at >= polled_at AND received_at <= polled_at + INTERVAL {limit}")
    return asked.join(got, in_time, "leftOuter").where("_id is null").select("request_id", "location", "polled_at")


def run_unanswered(polls: DataFrame, responses: DataFrame, out_dir: str, checkpoint: str, limit: str = "1 HOUR", lateness: str = "1 HOUR",
                   available_now: bool = True, interval: str = "1 minute", state_partitions: int | None = None):
    """Write each batch's unanswered requests, addressed by its id."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    writer = unanswered(polls, responses, limit, lateness).writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(state_partitions) if state_partitions else None}
    with _started_with(polls.sparkSession, settings):
        return _triggered(writer, available_now, interval).start()
