"""The weather status refresh.

Landed responses (chunks) -> one body per request -> parsed payload ->
per-key updates (latest wins) -> keyed update of the status table that never
inserts unknown keys -> new status snapshot, plus the two-line text log of
every successful response and audit rows for transport errors.

Semantics kept from the original poller, applied in arrival order
(``received_at``, then ``request_id``), last one wins per key:

* 200: set update_status='Success', data=<weather>, last_update=<arrival>
  on the row whose key equals the body's display city;
* other status: set only update_status='Failed' on the row of the polled
  location's key (via the ``location -> key`` mapping; the original looked
  it up with a loop variable that had already moved on, and with the
  location text rather than the city key, so it never hit a row);
* transport error (no status): no state change, other locations go on;
* 200 with a body that cannot be read: no state change.

The last two go to the audit. The arrival order holds across batches: a
response that is read late never overwrites a later one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.payload import parse_body, typed_conditions
from freshet.functions.text import request_path
from freshet.operators.keyed_update import update_no_insert
from freshet.operators.latest import latest_by_key, latest_value
from freshet.operators.ordinal import global_row_number
from freshet.operators.reassemble import reassemble
from freshet.operators.status import HTTP_OK, applies, update_status
from freshet.sources.response_log import read_response_log, write_response_log
from freshet.sources.schemas import status_names

ARRIVAL_ORDER = ("received_at", "request_id")


def seed_status(locations: DataFrame) -> DataFrame:
    """Initial status table: one row per key with its location, nothing set."""
    return locations.groupBy("key").agg(F.min("location").alias("location")).select(
        F.col("key").cast("string").alias("key"),
        F.col("location").cast("string").alias("location"),
        F.lit(None).cast("string").alias("data"),
        F.lit(None).cast("string").alias("update_status"),
        F.lit(None).cast("timestamp").alias("last_update"),
    )


def request_paths(locations: DataFrame, api_key: Column) -> DataFrame:
    """One request path per polled location (the key is a runtime parameter)."""
    return locations.select("key", "location", request_path(api_key, F.col("location")).alias("request_path"))


def response_bodies(responses: DataFrame, dealt_by: Sequence[str] = (), extra: Mapping | None = None) -> DataFrame:
    """Chunks -> (request_id, location, status, received_at, body). The chunks
    of one response are one small group, so the text is shuffled once; not at all
    if the chunks are dealt by ``dealt_by``, columns that a response has one value
    of. ``extra`` as in ``reassemble``."""
    return reassemble(
        responses, [*dealt_by, "request_id", "location", "status"], "seq", "chunk", out="body",
        extra={"received_at": (F.max("received_at"), F.max), **(extra or {})}, block=None,
    )


def parsed_bodies(responses: DataFrame) -> DataFrame:
    """Bodies with the two fields the refresh needs: city and weather. A body
    that is no JSON object of the expected form leaves them NULL."""
    return with_payload(response_bodies(responses))


def with_payload(bodies: DataFrame) -> DataFrame:
    co = F.col("_payload.current_observation")
    parsed = bodies.withColumn("_payload", parse_body(F.col("body")))
    return parsed.withColumns({"city": co["display_location"]["city"], "weather": co["weather"]}).drop("_payload")


def unparsable() -> Column:
    """A 200 response whose body names no city: nothing to update or to log."""
    return (F.col("status") == HTTP_OK) & F.col("city").isNull()


def keyed_responses(parsed: DataFrame, locations: DataFrame) -> DataFrame:
    """The last response per target, of those that change state, with the
    status key it targets: successes target their body's city, failures the
    polled location. Both are reduced first; only the last failure of each
    location then meets the mapping."""
    ok = F.col("status") == HTTP_OK
    kept = parsed.filter(applies(F.col("status")) & ~F.coalesce(unparsable(), F.lit(False)))
    carried = ["status", F.col("weather").alias("data"), *ARRIVAL_ORDER]
    last = kept.groupBy(ok.alias("_ok"), F.when(ok, F.col("city")).otherwise(F.col("location")).alias("_target")).agg(
        latest_value(carried, ARRIVAL_ORDER).alias("_r")).select("_ok", "_target", "_r.*")
    loc = locations.select(F.col("location").alias("_location"), F.col("key").alias("_key"))
    polled = F.when(~F.col("_ok"), F.col("_target"))  # NULL, so unmatched, for successes
    j = last.join(loc, polled == F.col("_location"), "left")
    key = F.when(F.col("_ok"), F.col("_target")).otherwise(F.col("_key"))
    return j.select(key.alias("key"), "status", "data", *ARRIVAL_ORDER).filter("key is not null")


def reduce_updates(rows: DataFrame) -> DataFrame:
    """Per key: the outcome of the last response and the last successful one.

    ``rows``: key, status, data, received_at, request_id (status not NULL).
    Output: key, set_status, update_status, seen_at, seen_id, set_ok, data,
    last_update, ok_at, ok_id.
    """
    agg = rows.groupBy("key").agg(
        latest_value(["status", *ARRIVAL_ORDER], ARRIVAL_ORDER).alias("_last"),
        latest_value(["data", *ARRIVAL_ORDER], ARRIVAL_ORDER, where=F.col("status") == HTTP_OK).alias("_ok"),
    )
    return agg.select(
        "key",
        F.col("_last").isNotNull().alias("set_status"),
        update_status(F.col("_last.status")).alias("update_status"),
        F.col("_last.received_at").alias("seen_at"), F.col("_last.request_id").alias("seen_id"),
        F.col("_ok").isNotNull().alias("set_ok"),
        F.col("_ok.data").alias("data"),
        F.col("_ok.received_at").alias("last_update"),
        F.col("_ok.received_at").alias("ok_at"), F.col("_ok.request_id").alias("ok_id"),
    )


# Arrival of the response that set update_status, and of the one that set data.
ARRIVAL_COLUMNS = {"_seen_at": "timestamp", "_seen_id": "long", "_ok_at": "timestamp", "_ok_id": "long"}


def with_arrival(status: DataFrame) -> DataFrame:
    """``status`` with its arrival columns; NULL where it has none yet."""
    return status.withColumns({c: F.lit(None).cast(t) for c, t in ARRIVAL_COLUMNS.items() if c not in status.columns})


def visible(status: DataFrame) -> DataFrame:
    """``status`` without its arrival columns."""
    return status.drop(*ARRIVAL_COLUMNS)


def refresh_status(status: DataFrame, updates: DataFrame) -> DataFrame:
    """Keyed update without insert; columns not set, further columns, names and
    types are kept. The arrival of what a row shows is kept beside it, and
    only later arrivals are applied: it does not matter in which batches, or
    how often, responses are read."""
    names = status_names(status)
    return update_no_insert(with_arrival(status), updates, names["key"], {
        names["update_status"]: ("set_status", "update_status"),
        names["data"]: ("set_ok", "data"),
        names["last_update"]: ("set_ok", "last_update"),
        "_seen_at": ("set_status", "seen_at"), "_seen_id": ("set_status", "seen_id"),
        "_ok_at": ("set_ok", "ok_at"), "_ok_id": ("set_ok", "ok_id"),
    }, {
        "set_status": (["seen_at", "seen_id"], ["_seen_at", "_seen_id"]),
        "set_ok": (["ok_at", "ok_id"], ["_ok_at", "_ok_id"]),
    })


def unapplied(parsed: DataFrame) -> DataFrame:
    """Audit rows for responses that change nothing: requests that got no
    response, and 200 responses with a body that cannot be read."""
    event = F.when(F.col("status").isNull(), F.lit("transport_error")).when(unparsable(), F.lit("unparsable_body"))
    return parsed.select(event.alias("event"), "request_id", "location", "received_at").filter("event is not null")


def status_listing(status: DataFrame) -> DataFrame:
    """Ordinal, location, data, update status, last update; ordered by key."""
    names = status_names(status)
    shown = status.select(*[F.col(c).alias(n) for n, c in names.items()])
    numbered = global_row_number(shown, ["key"], out="ordinal")
    return numbered.select("ordinal", "location", "data", "update_status", "last_update").orderBy("ordinal")


def append_log(parsed: DataFrame, path: str, mode: str = "append") -> None:
    """Two-line records of every successful response. JSON text has line breaks
    only between its tokens, so dropping them keeps the value."""
    one_line = lambda c: F.regexp_replace(c, r"[\r\n]+[ \t]*", "")
    write_response_log(
        parsed.filter((F.col("status") == HTTP_OK) & F.col("city").isNotNull()), path,
        city=one_line(F.col("city")), at=F.col("received_at"), body=one_line(F.col("body")), mode=mode,
    )


def ingest_log(spark: SparkSession, path: str) -> DataFrame:
    """Response log -> typed conditions table (one row per logged response)."""
    recs = read_response_log(spark, path)
    parsed = recs.withColumn("payload", parse_body(F.col("body")))
    return parsed.select(
        F.col("city").alias("logged_city"), "logged_at", *typed_conditions(F.col("payload"))
    )


def latest_reading(conditions: DataFrame) -> DataFrame:
    """Newest observation per city (ties broken by log time, then station)."""
    values = [c for c in conditions.columns if c != "city"]
    return latest_by_key(conditions, ["city"], ["observed_at", "logged_at", "station_id"], values)


def refresh(
    status: DataFrame, responses: DataFrame, locations: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Whole batch step: (new status, parsed bodies, audit of the unapplied)."""
    return refresh_parsed(status, parsed_bodies(responses), locations)


def refresh_parsed(
    status: DataFrame, parsed: DataFrame, locations: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The step after the bodies; three outputs read ``parsed``, so jobs stage it."""
    updates = reduce_updates(keyed_responses(parsed, locations))
    return refresh_status(status, updates), parsed, unapplied(parsed)
