"""The response log as a stream.

Files of the log are read once each as they land. A record that another run wrote
again (same city, time and body) is dropped while the first is younger than the
lateness; the state holds a digest per record, not the body, and forgets it after
that time. A record that is later than the lateness is not read any more: choose it
above the longest delay between a run and its repetition.

Records without a readable header, or whose body is no JSON object (a file cut
short), go to the quarantine with the name of their file. They are not
deduplicated: each damaged record is shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import ROCKSDB
from freshet.sources.response_log import read_response_log_stream
from freshet.streaming.state_stream import _started_with
from freshet.streaming.status_stream import _triggered


def is_whole(records: DataFrame) -> DataFrame:
    """``records`` with the flag ``whole``."""
    shape = F.schema_of_variant(F.try_parse_json("body"))
    whole = F.col("city").isNotNull() & F.col("logged_at").isNotNull() & F.coalesce(shape.startswith("OBJECT"), F.lit(False))
    return records.withColumn("whole", whole)


def new_records(records: DataFrame, lateness: str) -> DataFrame:
    """Whole records, each once."""
    good = is_whole(records).where("whole").drop("whole").withWatermark("logged_at", lateness)
    keyed = good.withColumn("_digest", F.sha2(F.encode("body", "UTF-8"), 256))
    return keyed.dropDuplicatesWithinWatermark(["city", "logged_at", "_digest"]).drop("_digest")


def run_log_stream(spark: SparkSession, log_dir: str, out_dir: str, quarantine_dir: str, checkpoint: str, lateness: str = "1 DAY",
                   max_files_per_trigger: int | None = None, available_now: bool = True, interval: str = "1 minute",
                   state_partitions: int | None = None):
    """Start both queries: (records, quarantine). Output is addressed by batch, so a
    repeated batch replaces its own."""
    def sink(folder: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

        return write

    records = read_response_log_stream(spark, log_dir, max_files_per_trigger)
    damaged = is_whole(records.withColumn("file", F.input_file_name())).where("NOT whole").drop("whole")
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(state_partitions) if state_partitions else None}
    started = []
    for df, folder, name in ((new_records(records, lateness), out_dir, "records"), (damaged, quarantine_dir, "quarantine")):
        writer = df.writeStream.outputMode("append").foreachBatch(sink(folder)).option("checkpointLocation", f"{checkpoint}/{name}")
        with _started_with(spark, settings):
            started.append(_triggered(writer, available_now, interval).start())
    return tuple(started)
