"""The status refresh on keyed state, in two streams.

``run_responses`` keeps each request's chunks in state until they are all there,
wherever the others landed: a batch costs its own chunks and what is known of the
requests filed with theirs. A whole response is written once, with its log record
and, if it changes nothing, its audit row. A request that is still incomplete
``give_up_after`` its newest chunk, by the watermark, goes to the audit. The same
timer forgets finished requests, and until then a chunk that lands twice changes
nothing.

``run_status`` reads the whole responses and keeps, per status key, the last
response and the last successful one (a streaming aggregate in the JVM). Each batch
writes the keys it changed. No batch reads or writes the status table: readers join
it with the newest state (``current_status``), in which keys that the table does
not have are never inserted.

Both address every output by the batch id, so a repeated batch replaces its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from freshet.operators.latest import latest_by_key
from freshet.operators.status import HTTP_OK, applies
from freshet.plans import weather
from freshet.session import ROCKSDB
from freshet.sources.schemas import status_names
from freshet.streaming.status_stream import _triggered, batch_paths, fold_outputs, newest_fold

# The processor runs in tasks; it is sent by value, so the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RESPONSE = "request_id long, event string, location string, status int, body string, received_at timestamp"
# What the processor gives: times as microseconds, free of any time zone.
_GIVEN = RESPONSE.replace("received_at timestamp", "received_us long")
_CHUNK = ("location", "status", "seq", "chunk", "received_us", "n_chunks")
_KNOWN = "waiting binary, finished binary, timer long"
_WAITING = pa.schema([("request_id", pa.int64()), ("location", pa.string()), ("status", pa.int32()), ("us", pa.int64()), ("n_chunks", pa.int32()),
                      ("seq", pa.int32()), ("chunk", pa.string())])
_FINISHED = pa.schema([("request_id", pa.int64()), ("us", pa.int64())])
# Fixed for a stream's life. So many that the waiting requests of one fit into a task
# with ease, so few that a batch brings each many chunks.
REQUEST_BUCKETS = 1024
STATE_COLUMNS = ("set_status", "update_status", "seen_at", "seen_id", "set_ok", "data", "last_update", "ok_at", "ok_id")


@contextmanager
def _started_with(spark: SparkSession, settings: dict[str, str | None]):
    """A stream clones the session's settings when it starts and keeps them."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            if v is not None:
                spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _state_settings(state_partitions: int | None) -> dict[str, str | None]:
    return {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.sql.shuffle.partitions": str(state_partitions) if state_partitions else None}


class _Waiting:
    """A request some of whose chunks are still to come."""

    def __init__(self, location: str | None, status: int | None, us: int, want: int | None):
        self.location, self.status, self.us, self.want, self.chunks = location, status, us, want, {}


def _int(value) -> int | None:
    """pandas has integers with NULLs among them as floats with NaN."""
    return None if value is None or value != value else int(value)


def _packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


class RequestChunks(StatefulProcessor):
    """Requests are filed in buckets by a hash of their id. Every call of the state is
    a round trip between Python and the JVM, so a batch that touches a bucket costs one
    read and one write for all its requests. The value holds two Arrow tables: the chunks
    of requests that wait for more, and the last arrival of those that are finished. The
    one timer of a bucket goes off with the first request that is due and is then set for
    the next, so it is early if newer chunks have come."""

    def __init__(self, give_up_ms: int):
        self.give_up_ms = give_up_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", _KNOWN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, finished, timer = self._load()
        touched = {}
        for frame in rows:
            requests = [_int(r) for r in frame["request"].tolist()]
            done = pc.is_in(pa.array(requests, pa.int64()), value_set=finished["request_id"]).to_pylist()
            for again, r, *values in zip(done, requests, *(frame[c].tolist() for c in _CHUNK)):
                if again:
                    continue  # chunks that landed twice
                location, status, seq, chunk, us, n_chunks = values
                w = touched.get(r)
                if w is None:
                    w = touched[r] = waiting.pop(r, None) or _Waiting(None, None, us, None)
                w.location, w.us = max(filter(None, (w.location, location)), default=None), max(w.us, us)
                status, n_chunks = _int(status), _int(n_chunks)
                w.status = w.status if status is None else status
                w.want = w.want if n_chunks is None else max(w.want or 0, n_chunks)
                w.chunks[seq] = chunk
        whole = {r: w for r, w in touched.items() if w.want is None or len(w.chunks) >= w.want}
        if whole:
            told = {r: [t for _, t in sorted(w.chunks.items()) if t is not None] for r, w in whole.items()}
            yield self._rows(whole, None, {r: "".join(t) for r, t in told.items() if t})
            new = pa.table([[*whole], [w.us for w in whole.values()]], schema=_FINISHED)
            finished = pa.concat_tables([finished, new])
        waiting |= {r: w for r, w in touched.items() if r not in whole}
        self._store(waiting, finished, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting, finished, timer = self._load()
        now = expiredTimerInfo.getExpiryTimeInMs()
        # All that are due, as if each had a timer of its own.
        due = max(now, timerValues.getCurrentWatermarkInMs() - 1)
        lost = {r: w for r, w in waiting.items() if self._limit(w.us) <= due}
        if lost:
            yield self._rows(lost, "incomplete_response", {})
        finished = finished.filter(pc.greater_equal(finished["us"], (due - self.give_up_ms + 1) * 1000))
        self._store({r: w for r, w in waiting.items() if r not in lost}, finished, None if timer == now else timer)

    def close(self) -> None:
        pass

    def _limit(self, us: int) -> int:
        return us // 1000 + self.give_up_ms

    def _load(self) -> tuple[dict[int | None, _Waiting], pa.Table, int | None]:
        found = self.known.get()
        if not found:
            return {}, _FINISHED.empty_table(), None
        chunks, finished = (pa.ipc.open_stream(bytes(t)).read_all() for t in found[:2])
        waiting = {}
        for r, location, status, us, want, seq, chunk in zip(*(c.to_pylist() for c in chunks.columns)):
            w = waiting.get(r)
            if w is None:
                w = waiting[r] = _Waiting(location, status, us, want)
            w.chunks[seq] = chunk
        return waiting, finished, found[2]

    def _store(self, waiting: dict[int | None, _Waiting], finished: pa.Table, timer: int | None) -> None:
        arrivals = [w.us for w in waiting.values()] + ([pc.min(finished["us"]).as_py()] if len(finished) else [])
        first = self._limit(min(arrivals)) if arrivals else None
        if timer is not None and (first is None or first < timer):
            self.handle.deleteTimer(timer)
            timer = None
        if first is None:
            self.known.clear()
            return
        if timer is None:
            self.handle.registerTimer(first)
        rows = [(r, w.location, w.status, w.us, w.want, seq, chunk) for r, w in waiting.items() for seq, chunk in w.chunks.items()]
        chunks = pa.table([*map(list, zip(*rows))], schema=_WAITING) if rows else _WAITING.empty_table()
        self.known.update((_packed(chunks), _packed(finished), first if timer is None else timer))

    @staticmethod
    def _rows(requests: dict[int | None, _Waiting], event: str | None, bodies: dict[int | None, str]) -> pd.DataFrame:
        rows = [(r, event, w.location, w.status, bodies.get(r), w.us) for r, w in requests.items()]
        return pd.DataFrame(rows, columns=["request_id", "event", "location", "status", "body", "received_us"], dtype=object)


def whole_responses(chunks: DataFrame, give_up_after: str, lateness: str, buckets: int = REQUEST_BUCKETS) -> DataFrame:
    """Streamed chunks -> whole responses (event NULL) and given-up requests."""
    ms = int(pd.Timedelta(give_up_after).total_seconds() * 1000)
    known = chunks.where("received_at is not null and seq is not null")  # without them there is no order
    bucket = F.pmod(F.xxhash64("request_id"), F.lit(buckets)).cast("int")
    # The id as text: as a float, beside NULLs, a long one would lose its last digits.
    marked = known.select(bucket.alias("bucket"), F.col("request_id").cast("string").alias("request"), "location", "status", "seq", "chunk",
                          F.unix_micros("received_at").alias("received_us"), "n_chunks", "received_at")
    given = marked.withWatermark("received_at", lateness).groupBy("bucket").transformWithStateInPandas(RequestChunks(ms), _GIVEN, "append", "EventTime")
    return given.withColumn("received_at", F.timestamp_micros("received_us")).drop("received_us")


def run_responses(chunks: DataFrame, out_dir: str, log_dir: str, audit_dir: str, checkpoint: str, give_up_after: str = "1 day",
                  lateness: str = "1 day", available_now: bool = True, interval: str = "1 minute", state_partitions: int | None = None,
                  buckets: int = REQUEST_BUCKETS):
    """Chunks to whole responses (``out_dir``), their log and the audit. Chunks
    that land more than ``lateness`` behind the newest are too late. ``buckets`` is
    how many values the state has; a stream keeps it, as its state partitions."""
    spark = chunks.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        path = f"{out_dir}/batch_id={batch_id}"
        weather.with_payload(batch).write.mode("overwrite").parquet(path)
        written = spark.read.parquet(path)
        whole = written.where("event is null")
        weather.append_log(whole, f"{log_dir}/batch_id={batch_id}", mode="overwrite")
        lost = written.where("event is not null").select("event", "request_id", "location", "received_at")
        weather.unapplied(whole).unionByName(lost).write.mode("overwrite").parquet(f"{audit_dir}/batch_id={batch_id}")

    writer = whole_responses(chunks, give_up_after, lateness, buckets).writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    with _started_with(spark, _state_settings(state_partitions)):
        return _triggered(writer, available_now, interval).start()


def run_status(spark: SparkSession, responses_dir: str, locations: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True,
               interval: str = "1 minute", state_partitions: int | None = None, max_files: int | None = None, fold_every: int = 100):
    """Whole responses to the state of each status key. ``locations`` is read as
    it is when the stream starts."""
    schema = f"{RESPONSE}, city string, weather string"
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    rows = reader.parquet(responses_dir).where("event is null").where(applies(F.col("status")) & ~F.coalesce(weather.unparsable(), F.lit(False)))
    ok = F.col("status") == HTTP_OK
    where = locations.select(F.col("location").alias("_location"), F.col("key").alias("_key"))
    polled = rows.join(where, F.when(~ok, F.col("location")) == F.col("_location"), "left")
    keyed = polled.select(F.when(ok, F.col("city")).otherwise(F.col("_key")).alias("key"), "status", F.col("weather").alias("data"), "received_at", "request_id")
    state = weather.reduce_updates(keyed.where("key is not null"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        if (batch_id + 1) % fold_every == 0:
            fold_outputs(spark, out_dir, batch_id, lambda: read_state(spark, out_dir))

    writer = state.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    with _started_with(spark, _state_settings(state_partitions)):
        return _triggered(writer, available_now, interval).start()


def read_state(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest state of every key: the last fold and the batches after it."""
    path, upto = newest_fold(spark, out_dir)
    later = batch_paths(spark, out_dir, upto)
    parts = [spark.read.parquet(path).withColumn("batch_id", F.lit(upto).cast("long"))] if path else []
    if later:
        parts.append(spark.read.option("basePath", out_dir).parquet(*later).withColumn("batch_id", F.col("batch_id").cast("long")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest_by_key(rows, ["key"], ["batch_id"], list(STATE_COLUMNS))


def current_status(status: DataFrame, state: DataFrame) -> DataFrame:
    """The status table with the state applied, in its own columns and types."""
    keyed = state.withColumn("key", F.col("key").cast(status.schema[status_names(status)["key"]].dataType))
    return weather.visible(weather.refresh_status(status, keyed))
