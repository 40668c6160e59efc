"""Registered queries: one Spark callable and, where SQL can say it, one

Every callable takes ``(spark, sf_dir)`` and reads whole tables; the oracle
statements run on the same parquet files registered as views. Column names
and types are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet import jobs
from freshet.functions.payload import to_json_text
from freshet.operators.latest import latest_by_key
from freshet.operators.materialize import materialize, materialize_counted
from freshet.operators.ordinal import global_row_number
from freshet.operators.reassemble import reassemble
from freshet.operators.snapshot import publish, publish_if, read_current, same_table, write_version
from freshet.operators.status import applies, update_status
from freshet.plans import renewal, weather
from freshet.plans.standins import (
    BROKEN_EVERY, STANDINS, conditions_log_records, landed_chunks, standin, status_locations, with_standins,
)
from freshet.session import work_path
from freshet.sources.landing import read_landed, read_landed_stream
from freshet.sources.response_log import read_response_log, write_response_log
from freshet.sources.tables import load
from freshet.streaming.status_stream import read_latest, run_latest_per_key, run_status_refresh

QueryFn = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- renewal --

def _renewal_inputs(spark: SparkSession, sf_dir: str):
    return tuple(standin(spark, sf_dir, n) for n in ("tariff", "tariff_domain", "tariff_data"))


def q_renewal_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, td, tv = _renewal_inputs(spark, sf_dir)
    return renewal.renewal_candidates(t, td, tv).orderBy("rnum")


def q_template_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, td, _ = _renewal_inputs(spark, sf_dir)
    return renewal.template_domains(t, td)


def q_global_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    return global_row_number(orders, ["o_orderkey"])


def q_commit_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", "event_type")
    numbered = global_row_number(events, ["event_id"])
    processed = numbered.filter(F.col("event_type") != "error").select("event_id", "rnum")
    return renewal.commit_batches(materialize(processed, "processed_events"))


def q_set_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    constants = orders.select(
        F.col("o_orderkey").alias("id"), day.alias("date_from"), F.date_add(day, 30).alias("date_to")
    )
    ldate = orders.select(F.max(day)).scalar()
    return renewal.set_constants(constants, ldate)


def q_mark_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, td, tv = _renewal_inputs(spark, sf_dir)
    cands = renewal.renewal_candidates(t, td, tv, with_rnum=False)
    return renewal.mark_ready(t, cands)


def q_clear_date_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, td, tv = _renewal_inputs(spark, sf_dir)
    cands = renewal.renewal_candidates(t, td, tv, with_rnum=False)
    return renewal.clear_date_from(tv, cands)


def q_error_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, td, tv = _renewal_inputs(spark, sf_dir)
    cands = renewal.renewal_candidates(t, td, tv, with_rnum=False)
    domains = renewal.template_domains(t, td)
    tmsg = renewal.tariff_messages(cands, td, standin(spark, sf_dir, "tariff_apply_result"))
    dmsg = renewal.domain_messages(domains, standin(spark, sf_dir, "approve_domain_result"))
    cols = ["stage", "id", "severity", "message"]
    return tmsg.select(*cols).unionByName(dmsg.select(*cols))


def q_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, td, tv = _renewal_inputs(spark, sf_dir)
    # Counted as they are written, then joined with the outcomes.
    cands, n_cands = materialize_counted(renewal.renewal_candidates(t, td, tv), "candidates")
    domains, n_domains = materialize_counted(renewal.template_domains(t, td), "domains")
    tmsg = renewal.tariff_messages(cands, td, standin(spark, sf_dir, "tariff_apply_result"))
    dmsg = renewal.domain_messages(domains, standin(spark, sf_dir, "approve_domain_result"))
    return renewal.audit_log(cands, domains, tmsg, dmsg, n_cands, n_domains)


def _wide(spark: SparkSession, sf_dir: str, name: str, *extra: str) -> DataFrame:
    """The stand-in with further columns of its table, some before its own."""
    source, cols = STANDINS[name]
    return load(spark, sf_dir, source).selectExpr(extra[0], *[f"{e} AS {c}" for c, e in cols.items()], *extra[1:])


def _constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), day.alias("date_from"), F.date_add(day, 30).alias("date_to"))


def _run_renewal(spark: SparkSession, sf_dir: str, root: str, ldate: str, reject: bool = False) -> None:
    res = jobs.run_renewal(
        spark, root, _wide(spark, sf_dir, "tariff", "c_mktsegment", "c_acctbal"), standin(spark, sf_dir, "tariff_domain"),
        _wide(spark, sf_dir, "tariff_data", "o_totalprice", "o_orderpriority"), _constants(spark, sf_dir),
        standin(spark, sf_dir, "tariff_apply_result"), standin(spark, sf_dir, "approve_domain_result"),
        ldate=F.lit(ldate).cast("date"), reject=reject,
    )
    if res.published == reject:
        raise RuntimeError(f"published: {res.published}, rejected: {reject}")


def _after_renewal(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "renewal_job")
    _run_renewal(spark, sf_dir, root, "2024-12-31")
    return read_current(spark, f"{root}/{table}")


def q_renewal_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tariff table the whole job publishes, with columns it does not know."""
    return _after_renewal("tariff", spark, sf_dir)


def q_renewal_job_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_renewal("tariff_data", spark, sf_dir)


def q_renewal_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constants readers get after one good and one rejected run."""
    root = work_path(spark, "renewal_rejected")
    _run_renewal(spark, sf_dir, root, "2024-12-31")
    _run_renewal(spark, sf_dir, root, "2030-12-31", reject=True)
    return read_current(spark, f"{root}/v_local_constants")


# The renewal selection over tables named tariff, tariff_domain, tariff_data
# (CTE bodies without WITH, so tests can run it over fixture tables).
RENEWAL_LOGIC_SQL = """joined AS (
  SELECT t.id AS t_id, t.tariff_domain__oid, t.name AS t_name, t.is_ready AS t_is_ready,
         v.id AS tv_id, v.is_ready AS tv_is_ready, v.date_from AS tv_date_from
  FROM tariff t
  JOIN tariff_domain d ON d.id = t.tariff_domain__oid AND d.is_personal = 'N'
  LEFT JOIN (SELECT * FROM tariff_data WHERE amnd_state = 'A') v ON v.tariff__oid = t.id
  WHERE t.amnd_state = 'A'),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY t_id, tv_id) AS rnum,
         max(tv_id) OVER (PARTITION BY t_id) AS newest_tv_id
  FROM joined),
cands AS (
  SELECT t_id, tariff_domain__oid, t_name, t_is_ready, tv_id, tv_is_ready, tv_date_from,
         CAST(rnum AS BIGINT) AS rnum
  FROM numbered
  WHERE tv_id IS NOT DISTINCT FROM newest_tv_id
    AND (t_is_ready <> 'Y' OR tv_is_ready <> 'Y')),
tdm AS (
  SELECT * FROM tariff_domain
  WHERE amnd_state = 'A' AND is_personal = 'T'
    AND id IN (SELECT tariff_domain__oid FROM tariff WHERE amnd_state = 'A' AND is_ready = 'N'))
"""


_RENEWAL_CTES = with_standins("tariff", "tariff_domain", "tariff_data") + ",\n" + RENEWAL_LOGIC_SQL

_MESSAGES_CTES = _RENEWAL_CTES + """,
""" + with_standins("tariff_apply_result", "approve_domain_result")[len("WITH "):] + """,
tmsg AS (
  SELECT 'TARIFFS' AS stage, c.t_id AS id, substr(r.err_msg, 1, 1) AS severity,
         'Approve failed for "' || coalesce(td.code, '') || '/' || coalesce(c.t_name, '')
           || '": ' || coalesce(r.err_msg, '') AS message,
         c.rnum AS seq
  FROM cands c
  LEFT JOIN tariff_apply_result r ON r.id = c.t_id
  LEFT JOIN tariff_domain td ON td.id = c.tariff_domain__oid
  WHERE c.tv_id IS NOT NULL AND substr(r.err_msg, 1, 1) = 'E'),
dmsg AS (
  SELECT 'TEMPLATE TARIFF DOMAINS' AS stage, d.id, substr(r.err_msg, 1, 1) AS severity,
         'Approve failed for ' || coalesce(d.code, '') AS message, d.id AS seq
  FROM tdm d LEFT JOIN approve_domain_result r ON r.id = d.id
  WHERE substr(r.err_msg, 1, 1) = 'E')
"""

RENEWAL_SQL = {
    "renewal_candidates": _RENEWAL_CTES + "SELECT * FROM cands ORDER BY rnum",
    "template_domains": _RENEWAL_CTES + "SELECT * FROM tdm",
    "global_ordinal": """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS rnum FROM orders""",
    "commit_batches": """
WITH r AS (SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) AS rnum FROM events),
p AS (SELECT event_id, rnum FROM r WHERE event_type <> 'error')
SELECT event_id, CAST(rnum AS BIGINT) AS rnum,
       CAST(COALESCE(SUM(CASE WHEN rnum % 5 = 0 THEN 1 ELSE 0 END)
            OVER (ORDER BY rnum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
         AS commit_batch
FROM p""",
    "set_constants": """
SELECT o_orderkey AS id,
       (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) + 1 AS date_from,
       CAST(NULL AS DATE) AS date_to
FROM orders""",
    "mark_ready": _RENEWAL_CTES + """
SELECT t.id, t.tariff_domain__oid, t.name,
       CASE WHEN c.t_id IS NOT NULL THEN 'Y' ELSE t.is_ready END AS is_ready, t.amnd_state
FROM tariff t LEFT JOIN (SELECT t_id FROM cands WHERE tv_id IS NULL) c ON c.t_id = t.id""",
    "clear_date_from": _RENEWAL_CTES + """
SELECT tv.id, tv.tariff__oid, tv.amnd_state, tv.is_ready,
       CASE WHEN c.tv_id IS NOT NULL THEN CAST(NULL AS DATE) ELSE tv.date_from END AS date_from
FROM tariff_data tv
LEFT JOIN (SELECT tv_id FROM cands WHERE tv_is_ready = 'N' AND tv_date_from IS NOT NULL) c
  ON c.tv_id = tv.id""",
    "renewal_job": _RENEWAL_CTES + """
SELECT c_mktsegment, t.id, t.tariff_domain__oid, t.name,
       CASE WHEN c.t_id IS NOT NULL THEN 'Y' ELSE t.is_ready END AS is_ready, t.amnd_state, c_acctbal
FROM customer JOIN tariff t ON t.id = c_custkey
LEFT JOIN (SELECT t_id FROM cands WHERE tv_id IS NULL) c ON c.t_id = t.id""",
    "renewal_job_versions": _RENEWAL_CTES + """
SELECT o_totalprice, tv.id, tv.tariff__oid, tv.amnd_state, tv.is_ready,
       CASE WHEN c.tv_id IS NOT NULL THEN CAST(NULL AS DATE) ELSE tv.date_from END AS date_from, o_orderpriority
FROM orders JOIN tariff_data tv ON tv.id = o_orderkey
LEFT JOIN (SELECT tv_id FROM cands WHERE tv_is_ready = 'N' AND tv_date_from IS NOT NULL) c
  ON c.tv_id = tv.id""",
    "renewal_rejected": """
SELECT o_orderkey AS id, DATE '2025-01-01' AS date_from, CAST(NULL AS DATE) AS date_to FROM orders""",
    "error_messages": _MESSAGES_CTES + """
SELECT stage, id, severity, message FROM tmsg
UNION ALL
SELECT stage, id, severity, message FROM dmsg""",
    "audit_log": _MESSAGES_CTES + """
SELECT 1 AS stage_no, 'TARIFFS' AS stage, 0 AS phase, CAST(0 AS BIGINT) AS seq, 'I' AS severity,
       'renewal: Action STARTED: Approve TARIFFS' AS message, CAST(NULL AS BIGINT) AS n_processed
UNION ALL
SELECT 1, 'TARIFFS', 2, 0, 'I', 'renewal: Action FINISHED: Approve TARIFFS',
       (SELECT count(*) FROM cands)
UNION ALL
SELECT 1, stage, 1, seq, severity, message, NULL FROM tmsg
UNION ALL
SELECT 2, 'TEMPLATE TARIFF DOMAINS', 0, 0, 'I',
       'renewal: Action STARTED: Approve TEMPLATE TARIFF DOMAINS', NULL
UNION ALL
SELECT 2, 'TEMPLATE TARIFF DOMAINS', 2, 0, 'I',
       'renewal: Action FINISHED: Approve TEMPLATE TARIFF DOMAINS', (SELECT count(*) FROM tdm)
UNION ALL
SELECT 2, stage, 1, seq, severity, message, NULL FROM dmsg""",
}

RENEWAL_QUERIES: dict[str, QueryFn] = {
    "renewal_candidates": q_renewal_candidates,
    "template_domains": q_template_domains,
    "global_ordinal": q_global_ordinal,
    "commit_batches": q_commit_batches,
    "set_constants": q_set_constants,
    "mark_ready": q_mark_ready,
    "clear_date_from": q_clear_date_from,
    "error_messages": q_error_messages,
    "audit_log": q_audit_log,
    "renewal_job": q_renewal_job,
    "renewal_job_versions": q_renewal_job_versions,
    "renewal_rejected": q_renewal_rejected,
}


# ---------------------------------------------------------------- weather --

# Placeholder for the runtime API key (never a real credential).
API_KEY = "API_KEY"
# The streams of the queries: landed files, files a batch takes, batches between
# two snapshots. What a poller lands and a trigger takes is set per deployment.
LANDED_FILES = 8
FILES_PER_TRIGGER = 2
COMPACT_EVERY = 2
LANDED_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"  # the JSON writer's own keeps milliseconds only


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    j = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner")
    return j.select(
        F.col("n_name").alias("key"),
        F.concat(F.col("r_name"), F.lit("/"), F.col("n_name")).alias("location"),
    )


def q_request_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.request_paths(_locations(spark, sf_dir), F.lit(API_KEY))


def q_status_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = standin(spark, sf_dir, "responses")
    return r.select(
        "request_id", "key", "status",
        update_status(F.col("status")).alias("update_status"),
        applies(F.col("status")).alias("applies"),
    )


_EVENT_BODY = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def q_log_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write events as two-line log records, read them back and parse them."""
    events = load(spark, sf_dir, "events")
    path = work_path(spark, "response_log")
    body = to_json_text(F.struct("event_id", "user_id", "event_type", "value", "props"))
    write_response_log(events, path, city=F.col("user_id").cast("string"), at=F.col("ts"),
                       body=body, mode="errorifexists")
    recs = read_response_log(spark, path)
    parsed = F.from_json(F.col("body"), _EVENT_BODY)
    return recs.select(
        F.col("city").alias("key"),
        F.col("logged_at").cast("timestamp_ntz").alias("logged_at"),
        parsed.alias("b"),
    ).select("key", "logged_at", "b.*")


_READING_COLUMNS = [
    "city", "weather", "temp_f", "wind_gust_mph", "relative_humidity", "precip_1hr_in",
    "heat_index_f", "solarradiation", "station_id",
]


def q_conditions_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a conditions log, ingest it into typed columns (sentinels become
    NULL, numbers sent as text are parsed), keep the newest reading per city."""
    recs = conditions_log_records(spark, sf_dir)
    path = work_path(spark, "conditions_log")
    write_response_log(recs, path, F.col("city"), F.col("at"), F.col("body"), mode="errorifexists")
    typed = weather.ingest_log(spark, path).select(*_READING_COLUMNS, "observed_at", "logged_at")
    latest = weather.latest_reading(typed)
    return latest.select(*_READING_COLUMNS, F.col("observed_at").cast("timestamp_ntz").alias("observed_at"))


def q_json_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    props = F.from_json(F.col("props"), "k INT")
    return events.select("event_id", "user_id", props["k"].alias("k"))


def q_reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = load(spark, sf_dir, "conversations")
    return reassemble(conv, ["conv_id"], "turn", "text", out="body",
                      extra={"n_chunks": (F.count(F.lit(1)), F.sum)})


def q_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = standin(spark, sf_dir, "responses")
    latest = latest_by_key(r, ["key"], weather.ARRIVAL_ORDER, ["data", "received_at", "request_id"])
    return latest.select("key", "data", F.col("received_at").alias("last_update"), "request_id")


def _refreshed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = standin(spark, sf_dir, "status")
    r = standin(spark, sf_dir, "responses")
    rows = r.filter(applies(F.col("status"))).select("key", "status", "data", "received_at", "request_id")
    return weather.visible(weather.refresh_status(state, weather.reduce_updates(rows)))


def q_keyed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed_status(spark, sf_dir)


def q_status_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.status_listing(materialize(_refreshed_status(spark, sf_dir), "refreshed_status"))


def q_status_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole landed-response path: chunks -> body -> JSON -> status split
    -> latest per key -> keyed update without insert."""
    state = standin(spark, sf_dir, "status").withColumn("key", F.col("key").cast("string"))
    new_status, _, _ = weather.refresh(state, landed_chunks(spark, sf_dir), status_locations(spark, sf_dir))
    return weather.visible(new_status)


def q_status_refresh_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status page over the refreshed string-keyed status table (an
    ordinal over a text key)."""
    return weather.status_listing(materialize(q_status_refresh(spark, sf_dir), "refreshed_status"))


def q_renewal_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit batch of every processed renewal candidate."""
    t, td, tv = _renewal_inputs(spark, sf_dir)
    cands = materialize(renewal.renewal_candidates(t, td, tv), "candidates")
    return renewal.commit_batches(cands).select("t_id", "rnum", "commit_batch")


def q_latest_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the responses as files, stream them (availableNow), keep the latest
    per key in streaming state, compact on the way, fold the outputs."""
    root = work_path(spark, "stream_latest")
    landing = f"{root}/landing"
    r = standin(spark, sf_dir, "responses")
    r.repartitionByRange(LANDED_FILES, "received_at", "request_id").write.parquet(landing)
    stream = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", str(FILES_PER_TRIGGER)).parquet(landing)
    values = ["data"]
    q = run_latest_per_key(stream, ["key"], weather.ARRIVAL_ORDER, values, f"{root}/out", f"{root}/_checkpoint",
                           compact_every=COMPACT_EVERY)
    q.awaitTermination()
    latest = read_latest(spark, f"{root}/out", ["key"], weather.ARRIVAL_ORDER, values)
    return latest.select("key", "data", F.col("received_at").alias("last_update"), "request_id")


def _seeded_status(spark: SparkSession, sf_dir: str, root: str) -> str:
    state = standin(spark, sf_dir, "status").withColumn("key", F.col("key").cast("string"))
    publish(spark, f"{root}/status", write_version(state, f"{root}/status"))
    return f"{root}/status"


def q_status_refresh_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refresh as a stream over landed JSON files: out of arrival order,
    and with the chunks of most responses spread over files and batches."""
    root = work_path(spark, "stream_status")
    status = _seeded_status(spark, sf_dir, root)
    chunks = landed_chunks(spark, sf_dir)
    chunks.repartition(LANDED_FILES, F.xxhash64("request_id", "seq")).write.option("timestampFormat", LANDED_TIME).json(f"{root}/landing")
    stream = read_landed_stream(spark, f"{root}/landing", max_files_per_trigger=FILES_PER_TRIGGER)
    run_status_refresh(spark, stream, status_locations(spark, sf_dir), status, f"{root}/log", f"{root}/audit",
                       f"{root}/_checkpoint", give_up_after="1000 days").awaitTermination()
    return weather.visible(read_current(spark, status))


def _refresh_job(spark: SparkSession, sf_dir: str, **kind: bool) -> str:
    """Landed JSON files through the batch job, which is run twice."""
    root = work_path(spark, "refresh_job")
    status = _seeded_status(spark, sf_dir, root)
    landed_chunks(spark, sf_dir, **kind).write.option("timestampFormat", LANDED_TIME).json(f"{root}/landing")
    for _ in range(2):
        jobs.run_status_refresh(spark, status, read_landed(spark, f"{root}/landing"), status_locations(spark, sf_dir),
                                f"{root}/log", f"{root}/audit", run_id="1")
    return root


def q_refresh_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the refresh could not apply: transport errors and broken bodies."""
    audit = spark.read.parquet(f"{_refresh_job(spark, sf_dir, broken=True)}/audit")
    return audit.select("event", "request_id", "location", F.col("received_at").cast("timestamp_ntz").alias("received_at"))


def q_refresh_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of bodies that came in many lines: its records, and how many
    lines it has (two for each)."""
    path = f"{_refresh_job(spark, sf_dir, pretty=True)}/log"
    lines = spark.read.text(path).count()
    return read_response_log(spark, path).select(
        "city", F.col("logged_at").cast("timestamp_ntz").alias("logged_at"), "body", F.lit(lines).cast("long").alias("log_lines"))


def q_publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the updated tariff_data as a new version; publish it only if no
    row was lost; return the published version."""
    t, td, tv = _renewal_inputs(spark, sf_dir)
    cands = renewal.renewal_candidates(t, td, tv, with_rnum=False)
    new_tv = renewal.clear_date_from(tv, cands)
    root = work_path(spark, "tables", "tariff_data")
    ok, _ = publish_if(spark, new_tv, root, gate=lambda written: same_table(written, tv))
    if not ok:
        raise RuntimeError("publish gate rejected the new tariff_data version")
    return read_current(spark, root)


_LATEST_SQL = with_standins("responses") + """
SELECT key, data, received_at AS last_update, request_id FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY received_at DESC, request_id DESC) AS rn
  FROM responses) WHERE rn = 1"""

_REFRESH_CTES = with_standins("responses", "status") + """,
v AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY received_at DESC, request_id DESC) AS rn
      FROM responses WHERE status IS NOT NULL),
ok AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY received_at DESC, request_id DESC) AS rn
       FROM responses WHERE status = 200),
refreshed AS (
  SELECT s.key, s.location,
         CASE WHEN ok.key IS NOT NULL THEN ok.data ELSE s.data END AS data,
         CASE WHEN v.key IS NOT NULL
              THEN CASE WHEN v.status = 200 THEN 'Success' ELSE 'Failed' END
              ELSE s.update_status END AS update_status,
         CASE WHEN ok.key IS NOT NULL THEN ok.received_at ELSE s.last_update END AS last_update
  FROM status s
  LEFT JOIN v ON v.key = s.key AND v.rn = 1
  LEFT JOIN ok ON ok.key = s.key AND ok.rn = 1)
"""

WEATHER_SQL = {
    "request_paths": f"""
SELECT n_name AS key, r_name || '/' || n_name AS location,
       '/api/' || '{API_KEY}' || '/conditions/q/' || r_name || '/' || n_name || '.json' AS request_path
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "status_split": with_standins("responses") + """
SELECT request_id, key, status,
       CASE WHEN status = 200 THEN 'Success' WHEN status IS NOT NULL THEN 'Failed' END AS update_status,
       status IS NOT NULL AS applies
FROM responses""",
    "log_round_trip": """
SELECT CAST(user_id AS VARCHAR) AS key, date_trunc('second', ts) AS logged_at,
       event_id, user_id, event_type, value, props
FROM events""",
    "json_project": """
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "reassemble": """
SELECT conv_id, string_agg(text, '' ORDER BY turn) AS body, count(*) AS n_chunks
FROM conversations GROUP BY conv_id""",
    "latest_state": _LATEST_SQL,
    "keyed_update": _REFRESH_CTES + "SELECT * FROM refreshed",
    "status_listing": _REFRESH_CTES + """
SELECT CAST(row_number() OVER (ORDER BY key) AS BIGINT) AS ordinal, location, data, update_status, last_update
FROM refreshed ORDER BY ordinal""",
    "latest_state_stream": _LATEST_SQL,
    "publish_gate": RENEWAL_SQL["clear_date_from"],
    "conditions_latest": """
WITH c AS (
  SELECT CAST(user_id AS VARCHAR) AS city, event_type AS weather, value AS temp_f,
         value AS wind_gust_mph,
         CAST(CAST(floor(value) AS BIGINT) % 100 AS DOUBLE) AS relative_humidity,
         CASE WHEN event_type = 'error' THEN NULL ELSE value END AS precip_1hr_in,
         CASE WHEN value < 50 THEN NULL ELSE value END AS heat_index_f,
         CASE WHEN event_type = 'view' THEN NULL ELSE 0.0 END AS solarradiation,
         CAST(event_id AS VARCHAR) AS station_id,
         date_trunc('second', ts) AS observed_at
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY city
                                   ORDER BY observed_at DESC, station_id DESC) AS rn FROM c)
SELECT city, weather, temp_f, wind_gust_mph, relative_humidity, precip_1hr_in, heat_index_f,
       solarradiation, station_id, observed_at
FROM r WHERE rn = 1""",
    "status_refresh_stream": _REFRESH_CTES + """
SELECT CAST(key AS VARCHAR) AS key, location, data, update_status, last_update FROM refreshed""",
    "refresh_audit": with_standins("responses") + f"""
SELECT CASE WHEN status IS NULL THEN 'transport_error' ELSE 'unparsable_body' END AS event,
       request_id, 'L/' || key AS location, received_at
FROM responses WHERE status IS NULL OR (status = 200 AND request_id % {BROKEN_EVERY} = 0)""",
    "refresh_log": with_standins("responses") + """
SELECT CAST(key AS VARCHAR) AS city, date_trunc('second', received_at) AS logged_at,
       '{"current_observation": {"display_location": {"city": "' || key || '"},"weather": "' || data || '"}}' AS body,
       2 * count(*) OVER () AS log_lines
FROM responses WHERE status = 200""",
    "status_refresh": _REFRESH_CTES + """
SELECT CAST(key AS VARCHAR) AS key, location, data, update_status, last_update FROM refreshed""",
    "status_refresh_listing": _REFRESH_CTES + """
SELECT CAST(row_number() OVER (ORDER BY CAST(key AS VARCHAR)) AS BIGINT) AS ordinal,
       location, data, update_status, last_update
FROM refreshed ORDER BY ordinal""",
    "renewal_batches": _RENEWAL_CTES + """
SELECT t_id, rnum,
       CAST(COALESCE(SUM(CASE WHEN rnum % 5 = 0 THEN 1 ELSE 0 END)
            OVER (ORDER BY rnum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
         AS commit_batch
FROM cands""",
}

WEATHER_QUERIES: dict[str, QueryFn] = {
    "request_paths": q_request_paths,
    "status_split": q_status_split,
    "log_round_trip": q_log_round_trip,
    "json_project": q_json_project,
    "reassemble": q_reassemble,
    "latest_state": q_latest_state,
    "keyed_update": q_keyed_update,
    "status_listing": q_status_listing,
    "latest_state_stream": q_latest_state_stream,
    "publish_gate": q_publish_gate,
    "status_refresh": q_status_refresh,
    "status_refresh_stream": q_status_refresh_stream,
    "refresh_audit": q_refresh_audit,
    "refresh_log": q_refresh_log,
    "renewal_batches": q_renewal_batches,
    "conditions_latest": q_conditions_latest,
    "status_refresh_listing": q_status_refresh_listing,
}


def queries() -> dict[str, QueryFn]:
    from freshet.plans import catalog_state

    return {**RENEWAL_QUERIES, **WEATHER_QUERIES, **catalog_state.QUERIES}


def oracle_sql() -> dict[str, str]:
    from freshet.plans import catalog_state

    return {**RENEWAL_SQL, **WEATHER_SQL, **catalog_state.SQL}
