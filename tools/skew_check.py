"""Run the renewal candidates on a skewed version table and report, per stage,
how evenly the work spread over tasks (from Spark's event log).

    python tools/skew_check.py [sf_dir] [scratch_dir] [versions|chunks|status]

The versions table is ``orders`` with a third of its rows re-pointed at one
tariff (and made active), i.e. one key holding a third of all rows. The
result is checked against DuckDB, then the event log is read back: for each
stage, task count, max and median records (input + shuffle read) and the
longest task.

Case ``chunks``: a third of all conversation turns are moved into one
conversation (turns renumbered to stay unique), then reassembled into
bodies; the per-block stage should stay balanced and the final stage
only joins block parts.

Case ``status``: a third of all responses are re-pointed at one status key,
then the whole landed-response refresh runs (chunks -> body -> JSON ->
latest per key -> keyed update); the per-key reduction should stay
balanced because it combines map-side.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HOT_KEY = 0


def skewed_versions(spark, sf_dir):
    from pyspark.sql import functions as F

    from freshet.plans.standins import standin

    tv = standin(spark, sf_dir, "tariff_data")
    hot = (F.col("id") % 3) == 0  # every third version moves to the hot tariff
    return tv.select(
        "id",
        F.when(hot, F.lit(HOT_KEY).cast("long")).otherwise(F.col("tariff__oid")).alias("tariff__oid"),
        F.when(hot, F.lit("A")).otherwise(F.col("amnd_state")).alias("amnd_state"),
        "is_ready", "date_from",
    )


def _event_lines(log_dir):
    """Lines of every event file (Spark 4 rolls them and compresses with zstd)."""
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        with open(path, "rb") as f:
            raw = f.read()
        if path.endswith(".zstd"):
            import zstandard

            with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as r:
                raw = r.read()
        yield from raw.decode().splitlines()


def stage_report(log_dir):
    tasks, names = {}, {}
    for line in _event_lines(log_dir):
        ev = json.loads(line)
        if ev.get("Event") == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            names[info["Stage ID"]] = info["Stage Name"].split(" at ")[0]
        if ev.get("Event") != "SparkListenerTaskEnd":
            continue
        m = ev.get("Task Metrics") or {}
        recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
        tasks.setdefault(ev["Stage ID"], []).append((recs, m.get("Executor Run Time", 0)))
    rows = []
    for sid in sorted(tasks):
        recs = [r for r, _ in tasks[sid]]
        rows.append((sid, names.get(sid, "?"), len(recs), max(recs), statistics.median(recs),
                     max(t for _, t in tasks[sid])))
    return rows


def _session(log_dir):
    from freshet.session import build_session

    # Small splits and no coalescing, so the spread over tasks is visible at small scale.
    return build_session(shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file:{log_dir}",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": str(256 * 1024),
    })


def _report(log_dir):
    print("stage  tasks  max_records  median_records  max_task_ms  name")
    for sid, name, n, mx, med, ms in stage_report(log_dir):
        print(f"{sid:5d}  {n:5d}  {mx:11d}  {med:14.0f}  {ms:11d}  {name}")


def check_chunks(sf_dir, scratch, log_dir):
    import duckdb
    from pyspark.sql import functions as F

    from freshet.operators.reassemble import reassemble
    from freshet.sources.tables import load

    spark = _session(log_dir)
    conv = load(spark, sf_dir, "conversations")
    hot = (F.col("conv_id") % 3) == 0  # a third of the conversations merge into one
    skewed = conv.select(
        F.when(hot, F.lit(HOT_KEY).cast("long")).otherwise(F.col("conv_id")).alias("conv_id"),
        F.when(hot, F.col("conv_id") * 100000 + F.col("turn")).otherwise(F.col("turn")).alias("turn"),
        "text",
    )
    path = os.path.join(scratch, "chunks")
    skewed.repartition(8).write.parquet(path)
    got = sorted(tuple(r) for r in reassemble(spark.read.parquet(path), ["conv_id"], "turn", "text").collect())
    spark.stop()
    want = sorted(duckdb.sql(
        f"SELECT conv_id, string_agg(text, '' ORDER BY turn) FROM read_parquet('{path}/*.parquet') "
        "GROUP BY conv_id").fetchall())
    print(f"bodies: {len(got)} rows, hot body {max(len(b or '') for _, b in got)} chars, "
          f"equal to DuckDB: {got == want}")
    _report(log_dir)
    return 0 if got == want else 1


def check_status(sf_dir, scratch, log_dir):
    import duckdb
    from pyspark.sql import functions as F

    from freshet.plans import weather
    from freshet.plans.standins import landed_chunks, standin, status_locations

    spark = _session(log_dir)
    hot = (F.col("request_id") % 3) == 0  # a third of the responses go to one key
    chunks = landed_chunks(spark, sf_dir)
    # the body names the city; re-point it (and the location) for the hot third
    chunks = chunks.withColumn("chunk", F.when(hot, F.regexp_replace("chunk", r'"city":"[0-9]+"', '"city":"0"'))
                               .otherwise(F.col("chunk"))) \
                   .withColumn("location", F.when(hot, F.lit("L/0")).otherwise(F.col("location")))
    path = os.path.join(scratch, "chunks")
    chunks = chunks.withColumn("received_at", F.col("received_at").cast("timestamp_ntz"))  # as the status has it
    chunks.repartition(8).write.parquet(path)
    state = standin(spark, sf_dir, "status").withColumn("key", F.col("key").cast("string"))
    new, _, _ = weather.refresh(state, spark.read.parquet(path), status_locations(spark, sf_dir))
    got = sorted(tuple(r) for r in weather.visible(new).collect())
    state.write.parquet(os.path.join(scratch, "state"))
    status_locations(spark, sf_dir).write.parquet(os.path.join(scratch, "locations"))
    spark.stop()
    con = duckdb.connect()
    for n in ("chunks", "state", "locations"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{scratch}/{n}/*.parquet')")
    want = sorted(con.sql("""
      WITH bodies AS (
        SELECT request_id, location, status, max(received_at) AS received_at,
               string_agg(chunk, '' ORDER BY seq) AS body
        FROM chunks GROUP BY request_id, location, status),
      keyed AS (
        SELECT CASE WHEN b.status = 200 THEN json_extract_string(b.body, '$.current_observation.display_location.city')
                    ELSE l.key END AS key,
               b.status, json_extract_string(b.body, '$.current_observation.weather') AS data,
               b.received_at, b.request_id
        FROM bodies b LEFT JOIN locations l ON l.location = b.location
        WHERE b.status IS NOT NULL),
      v AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY received_at DESC, request_id DESC) rn FROM keyed),
      ok AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY received_at DESC, request_id DESC) rn
             FROM keyed WHERE status = 200)
      SELECT s.key, s.location,
             CASE WHEN ok.key IS NOT NULL THEN ok.data ELSE s.data END,
             CASE WHEN v.key IS NOT NULL THEN CASE WHEN v.status = 200 THEN 'Success' ELSE 'Failed' END
                  ELSE s.update_status END,
             CASE WHEN ok.key IS NOT NULL THEN ok.received_at ELSE s.last_update END
      FROM state s LEFT JOIN v ON v.key = s.key AND v.rn = 1
      LEFT JOIN ok ON ok.key = s.key AND ok.rn = 1""").fetchall())
    print(f"status rows: {len(got)}, equal to DuckDB: {got == want}")
    _report(log_dir)
    return 0 if got == want else 1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    scratch = argv[2] if len(argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    case = argv[3] if len(argv) > 3 else "versions"
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    if case == "chunks":
        return check_chunks(sf_dir, scratch, log_dir)
    if case == "status":
        return check_status(sf_dir, scratch, log_dir)

    import duckdb

    from freshet.plans import renewal
    from freshet.plans.catalog import RENEWAL_LOGIC_SQL
    from freshet.plans.standins import standin

    spark = _session(log_dir)
    t, td = standin(spark, sf_dir, "tariff"), standin(spark, sf_dir, "tariff_domain")
    tv = skewed_versions(spark, sf_dir)
    vpath = os.path.join(scratch, "versions")
    tv.repartition(8).write.parquet(vpath)
    tv = spark.read.parquet(vpath)
    got = sorted(tuple(r) for r in renewal.renewal_candidates(t, td, tv).collect())
    t.write.parquet(os.path.join(scratch, "tariff"))
    td.write.parquet(os.path.join(scratch, "tariff_domain"))
    spark.stop()

    con = duckdb.connect()
    for view, d in (("tariff", "tariff"), ("tariff_domain", "tariff_domain"), ("tariff_data", "versions")):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{scratch}/{d}/*.parquet')")
    want = sorted(con.sql("WITH " + RENEWAL_LOGIC_SQL + "SELECT * FROM cands").fetchall())
    print(f"candidates: {len(got)} rows, equal to DuckDB: {got == want}")
    _report(log_dir)
    return 0 if got == want else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
