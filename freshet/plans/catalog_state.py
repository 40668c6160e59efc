"""Registered queries on keyed state, trees and running folds, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.payload import to_json_text
from freshet.functions.variant_payload import field_kinds, variant_body, variant_conditions
from freshet.operators.buckets import BucketedTable
from freshet.operators.materialize import materialize
from freshet.operators.progress import run_in_waves
from freshet.operators.stored_ordinal import stored_row_number
from freshet.plans import catalog, renewal, weather
from freshet.plans.standins import conditions_log_records, landed_chunks, standin, status_locations, with_standins
from freshet.session import work_path
from freshet.sources.landing import read_landed_stream
from freshet.sources.response_log import read_response_log, write_response_log
from freshet.sources.tables import load
from freshet.streaming.log_stream import run_log_stream
from freshet.streaming.state_stream import current_status, read_state, run_responses, run_status
from freshet.streaming.unanswered import run_unanswered

# ------------------------------------------------------------------ trees --

# Fixed values of the stand-in trees (own choice):
#   domains   parent is the domain numbered like the region, if that is a smaller number
#   customers parent is half the key; of two neighbours each (keys 97 k and 97 k + 1) are
#             each other's parent; a balance under -900 names a parent that is not there
DOMAIN_PARENT = "CASE WHEN n_regionkey < n_nationkey THEN CAST(n_regionkey AS BIGINT) END"
CUSTOMER_PARENT = ("CASE WHEN c_acctbal < -900 THEN -1 WHEN c_custkey % 97 = 0 THEN c_custkey + 1 "
                   "WHEN c_custkey % 97 = 1 AND c_custkey > 1 THEN c_custkey - 1 "
                   "WHEN c_custkey > 1 THEN (c_custkey - c_custkey % 2) / 2 END")


def _domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS id", f"{DOMAIN_PARENT} AS parent_id", "n_name AS code")


def q_domain_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the customers' tree with its path, depth and state."""
    nodes = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", f"CAST({CUSTOMER_PARENT} AS BIGINT) AS parent_id", "CAST(c_custkey % 100 AS STRING) AS code")
    return renewal.domain_paths(nodes)


def _messages(spark: SparkSession, sf_dir: str, codes: DataFrame | None = None, carry: bool = False) -> DataFrame:
    t, td, tv = (standin(spark, sf_dir, n) for n in ("tariff", "tariff_domain", "tariff_data"))
    cands = materialize(renewal.renewal_candidates(t, td, tv), "candidates")
    msgs = renewal.tariff_messages(cands, td if codes is None else codes, standin(spark, sf_dir, "tariff_apply_result"), carry)
    return msgs.select("stage", "id", "severity", "message", "seq")


def q_error_messages_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tariff messages with the domain's path in its tree."""
    codes = renewal.domain_paths(_domains(spark, sf_dir)).select("id", F.col("path").alias("code"))
    return _messages(spark, sf_dir, codes)


def q_error_messages_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tariff messages with the error text carried over, as the original does."""
    return _messages(spark, sf_dir, carry=True)


# The wave before which the query's first run dies, of how many.
DIES_AT, WAVES = 2, 4


class Killed(Exception):
    """Stands for a driver that dies."""


def q_renewal_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The renewal's steps in waves of commit batches: a run that dies between two
    waves, and one that goes on from there."""
    root = work_path(spark, "renewal_restart")
    t, td, tv = (standin(spark, sf_dir, n) for n in ("tariff", "tariff_domain", "tariff_data"))
    results = standin(spark, sf_dir, "tariff_apply_result")
    plan = lambda: renewal.commit_batches(materialize(renewal.renewal_candidates(t, td, tv), "candidates"))
    work = lambda batches: renewal.processed(batches, td, results)
    begun: list[int] = []

    def dies(wave: int) -> None:
        if wave == DIES_AT:
            raise Killed

    try:
        run_in_waves(spark, root, plan, work, WAVES, before_wave=dies)
    except Killed:
        pass
    out = run_in_waves(spark, root, plan, work, WAVES, before_wave=begun.append)
    if begun[:1] not in ([], [DIES_AT]):
        raise RuntimeError(f"waves {begun} were done again")
    return out.drop("wave")


def _message_sql(code: str, carry: bool) -> str:
    applied = "CASE WHEN c.tv_id IS NOT NULL THEN {'e': r.err_msg} END"
    text = f"(last_value({applied} IGNORE NULLS) OVER (ORDER BY c.rnum ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)).e" if carry else f"({applied}).e"
    return f""",
applied AS (
  SELECT c.*, {text} AS err FROM cands c LEFT JOIN tariff_apply_result r ON r.id = c.t_id)
SELECT 'TARIFFS' AS stage, a.t_id AS id, substr(err, 1, 1) AS severity,
       'Approve failed for "' || coalesce({code}, '') || '/' || coalesce(t_name, '') || '": ' || err AS message, a.rnum AS seq
FROM applied a LEFT JOIN names d ON d.id = a.tariff_domain__oid
WHERE substr(err, 1, 1) = 'E'"""


def _tree_sql(nodes: str) -> str:
    """CTEs nodes, tree (id, path, depth, state) over a query of nodes."""
    return f"""nodes AS ({nodes}),
tree(id, path, depth, state) AS (
  SELECT id, coalesce(code, ''), CAST(0 AS BIGINT), CASE WHEN parent_id IS NULL THEN 'rooted' ELSE 'orphan' END
  FROM nodes WHERE parent_id IS NULL OR parent_id NOT IN (SELECT id FROM nodes)
  UNION ALL
  SELECT n.id, t.path || '/' || coalesce(n.code, ''), t.depth + 1, t.state FROM tree t JOIN nodes n ON n.parent_id = t.id),
paths AS (
  SELECT * FROM tree UNION ALL
  SELECT id, coalesce(code, ''), NULL, 'cycle' FROM nodes WHERE id NOT IN (SELECT id FROM tree))"""


_RENEWAL = with_standins("tariff", "tariff_domain", "tariff_data", "tariff_apply_result")[len("WITH "):] + ",\n" + catalog.RENEWAL_LOGIC_SQL

# --------------------------------------------------------------- requests --

# Fixed values of the stand-in polls: which requests never land a row, which land
# one after the limit, and how many minutes the others take.
SILENT, LATE, MINUTES = 13, 17, 50
LIMIT = "1 HOUR"
SLICES = 6


def _polls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = load(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    polls = e.select(F.col("event_id").alias("request_id"), F.concat(F.lit("L/"), F.col("user_id").cast("string")).alias("location"), F.col("ts").alias("polled_at"))
    after = F.when(F.col("event_id") % LATE == 0, 120).otherwise(F.col("event_id") % MINUTES)
    got = e.where(F.col("event_id") % SILENT != 0).select(
        F.col("event_id").alias("request_id"), F.timestamp_add("MINUTE", after.cast("int"), F.col("ts")).alias("received_at"))
    return polls, got


def q_unanswered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls and responses land in slices of time, one after the other, and are
    streamed; the last slice holds one poll and one response much later, as polling
    goes on."""
    root = work_path(spark, "unanswered")
    polls, got = _polls(spark, sf_dir)
    # Two numbers for the whole table.
    low, high = (r // 1_000_000 for r in polls.select(F.unix_micros(F.min("polled_at")), F.unix_micros(F.max("polled_at"))).first())
    width = (high - low) // SLICES + 1
    ahead = F.timestamp_seconds(F.lit(high + 10 * width + 100 * 3600))
    tick = spark.range(1).select(F.lit(-1).cast("long").alias("request_id"), F.lit("tick").alias("location"), ahead.alias("polled_at"))
    for table, name, at in ((polls, "polls", "polled_at"), (got, "responses", "received_at")):
        place = F.least(F.floor((F.unix_seconds(at) - low) / width), F.lit(SLICES))
        for i in range(SLICES + 1):  # a response may land past the last poll's slice
            table.where(place == i).repartition(catalog.FILES_PER_TRIGGER).write.parquet(f"{root}/{name}/slice={i}")
        tick.select("request_id", *(["location"] if name == "polls" else []), F.col("polled_at").alias(at)).write.parquet(f"{root}/{name}/slice={SLICES + 1}")
    read = lambda name, schema: spark.readStream.schema(schema).option("recursiveFileLookup", "true").option(
        "maxFilesPerTrigger", str(catalog.FILES_PER_TRIGGER)).parquet(f"{root}/{name}")
    run_unanswered(read("polls", polls.schema), read("responses", got.schema), f"{root}/out", f"{root}/_checkpoint", LIMIT,
                   f"{2 * width + 7200} SECONDS").awaitTermination()
    out = spark.read.parquet(f"{root}/out").where("request_id >= 0")
    return out.select("request_id", "location", F.col("polled_at").cast("timestamp_ntz").alias("polled_at"))


def q_status_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed chunks, out of order and spread over files, through keyed state;
    the status table is only read, at the end."""
    root = work_path(spark, "state_stream")
    status = standin(spark, sf_dir, "status").withColumn("key", F.col("key").cast("string"))
    landed_chunks(spark, sf_dir).repartition(catalog.LANDED_FILES, F.xxhash64("request_id", "seq")).write.option(
        "timestampFormat", catalog.LANDED_TIME).json(f"{root}/landing")
    chunks = read_landed_stream(spark, f"{root}/landing", max_files_per_trigger=catalog.FILES_PER_TRIGGER)
    run_responses(chunks, f"{root}/whole", f"{root}/log", f"{root}/audit", f"{root}/_checkpoint_whole",
                  give_up_after="1000 days", lateness="1000 days").awaitTermination()
    run_status(spark, f"{root}/whole", status_locations(spark, sf_dir), f"{root}/state", f"{root}/_checkpoint_state",
               fold_every=catalog.COMPACT_EVERY).awaitTermination()
    return current_status(status, read_state(spark, f"{root}/state"))


# -------------------------------------------------------- sparse updates --

TARIFF_DATA_BUCKETS = 32


def q_clear_date_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clear_date_from on a table in buckets: only those with a version to clear are
    written again."""
    t, td, tv = (standin(spark, sf_dir, n) for n in ("tariff", "tariff_domain", "tariff_data"))
    cands = materialize(renewal.renewal_candidates(t, td, tv, with_rnum=False), "candidates")
    stored = BucketedTable(work_path(spark, "tariff_data_buckets"), "id", TARIFF_DATA_BUCKETS)
    stored.create(tv)
    stored.update(renewal.versions_to_clear(cands), lambda rows: renewal.clear_date_from(rows, cands))
    return stored.read(spark)


# ------------------------------------------------ an ordinal kept up to date --

ORDINAL_RANGES = 32  # asked for, of all orders; more as pieces are cut


def q_ordinal_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders numbered by date: the finished ones are stored, the open ones and the
    others are added."""
    orders = load(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_orderstatus")
    status = F.coalesce("o_orderstatus", F.lit(""))
    parts = [orders.where(status == "F"), orders.where(status == "O"), orders.where(~status.isin("F", "O"))]
    capacity = orders.count() // ORDINAL_RANGES + 1
    rows = stored_row_number(parts, work_path(spark, "stored_ordinal"), ["o_orderdate", "o_orderkey"], capacity)
    return rows.select("o_orderkey", "o_orderstatus", "rnum")


# -------------------------------------------------------- the log, streamed --

def q_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log records of two runs, one of them written a second time, and a
    run whose bodies are cut short; streamed, each whole record once."""
    root = work_path(spark, "log_stream")
    events = load(spark, sf_dir, "events")
    body = to_json_text(F.struct("event_id", "user_id", "event_type", "value", "props"))
    cut = F.substring(body, 1, F.char_length(body) - 1)
    odd = F.col("event_id") % 2 == 1
    for run, rows, text in ((0, ~odd, body), (1, odd, body), (2, odd, body), (3, F.col("event_type") == "error", cut)):
        write_response_log(events.where(rows).repartition(catalog.FILES_PER_TRIGGER), f"{root}/log/run={run}",
                           city=F.col("user_id").cast("string"), at=F.col("ts"), body=text, mode="errorifexists")
    for query in run_log_stream(spark, f"{root}/log", f"{root}/records", f"{root}/quarantine", f"{root}/_checkpoint",
                                lateness="1000 days", max_files_per_trigger=catalog.FILES_PER_TRIGGER):
        query.awaitTermination()
    recs = spark.read.parquet(f"{root}/records")
    return recs.select(F.col("city").alias("key"), F.col("logged_at").cast("timestamp_ntz").alias("logged_at"),
                       F.from_json("body", catalog._EVENT_BODY).alias("b")).select("key", "logged_at", "b.*")


# --------------------------------------------------------------- payloads --

def _logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conditions log, written and read back."""
    recs = conditions_log_records(spark, sf_dir)
    path = work_path(spark, "conditions_log")
    write_response_log(recs, path, F.col("city"), F.col("at"), F.col("body"), mode="errorifexists")
    return read_response_log(spark, path)


def q_payload_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each logged field came as which type, and which fields change."""
    return field_kinds(_logged(spark, sf_dir))


def q_conditions_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest reading per city, read through variants instead of a schema."""
    recs = _logged(spark, sf_dir).withColumn("v", variant_body(F.col("body")))
    names = catalog._READING_COLUMNS
    typed = recs.select("logged_at", *variant_conditions(F.col("v"))).select(*names, "observed_at", "logged_at")
    return weather.latest_reading(typed).select(*names, F.col("observed_at").cast("timestamp_ntz").alias("observed_at"))


_SENT = {
    "display_location": "'object'", "station_id": "'text'", "observation_epoch": "'text'", "weather": "'text'", "temp_f": "'number'",
    "wind_gust_mph": "CASE WHEN event_type IN ('click', 'view') THEN 'text' ELSE 'number' END", "relative_humidity": "'text'", "precip_1hr_in": "'text'",
    "heat_index_f": "CASE WHEN value < 50 THEN 'text' ELSE 'number' END", "solarradiation": "'text'",
}

QUERIES = {
    "ordinal_increments": q_ordinal_increments,
    "clear_date_from_buckets": q_clear_date_from_buckets,
    "log_stream": q_log_stream,
    "payload_drift": q_payload_drift,
    "conditions_variant": q_conditions_variant,
    "domain_paths": q_domain_paths,
    "error_messages_paths": q_error_messages_paths,
    "error_messages_as_written": q_error_messages_as_written,
    "renewal_restart": q_renewal_restart,
    "unanswered_requests": q_unanswered_requests,
    "status_state_stream": q_status_state_stream,
}
SQL = {
    "ordinal_increments": "SELECT o_orderkey, o_orderstatus, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS rnum FROM orders",
    "clear_date_from_buckets": catalog.RENEWAL_SQL["clear_date_from"],
    "log_stream": catalog.WEATHER_SQL["log_round_trip"],
    "payload_drift": "WITH sent AS (" + " UNION ALL ".join(f"SELECT '{f}' AS field, {k} AS kind FROM events" for f, k in _SENT.items()) + """),
counts AS (SELECT field, kind, count(*) AS n FROM sent GROUP BY field, kind)
SELECT field, kind, n, count(*) OVER (PARTITION BY field) > 1 AS drifts FROM counts""",
    "conditions_variant": catalog.WEATHER_SQL["conditions_latest"],
    "domain_paths": "WITH RECURSIVE " + _tree_sql(f"SELECT c_custkey AS id, CAST({CUSTOMER_PARENT} AS BIGINT) AS parent_id, CAST(c_custkey % 100 AS VARCHAR) AS code FROM customer")
                    + "\nSELECT * FROM paths",
    "error_messages_paths": "WITH RECURSIVE " + _tree_sql(f"SELECT CAST(n_nationkey AS BIGINT) AS id, {DOMAIN_PARENT} AS parent_id, n_name AS code FROM nation")
                            + ",\nnames AS (SELECT id, path AS code FROM paths),\n" + _RENEWAL + _message_sql("d.code", carry=False),
    "error_messages_as_written": "WITH names AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS code FROM nation),\n" + _RENEWAL + _message_sql("d.code", carry=True),
    "renewal_restart": "WITH " + _RENEWAL + """,
batches AS (
  SELECT *, CAST(COALESCE(SUM(CASE WHEN rnum % 5 = 0 THEN 1 ELSE 0 END)
                 OVER (ORDER BY rnum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS commit_batch FROM cands)
SELECT b.t_id, rnum, commit_batch,
       CASE WHEN tv_id IS NULL THEN 'mark_ready' WHEN tv_is_ready = 'N' AND tv_date_from IS NOT NULL THEN 'clear_and_apply' ELSE 'apply' END AS action,
       CASE WHEN failed THEN 'E' END AS severity,
       CASE WHEN failed THEN 'Approve failed for "' || coalesce(d.n_name, '') || '/' || coalesce(t_name, '') || '": ' || err_msg END AS message
FROM (SELECT b.*, r.err_msg, tv_id IS NOT NULL AND coalesce(substr(r.err_msg, 1, 1) = 'E', false) AS failed
      FROM batches b LEFT JOIN tariff_apply_result r ON r.id = b.t_id) b
LEFT JOIN nation d ON d.n_nationkey = b.tariff_domain__oid""",
    "unanswered_requests": f"SELECT event_id AS request_id, 'L/' || user_id AS location, ts AS polled_at FROM events WHERE event_id % {SILENT} = 0 OR event_id % {LATE} = 0",
    "status_state_stream": catalog.WEATHER_SQL["status_refresh_stream"],
}
