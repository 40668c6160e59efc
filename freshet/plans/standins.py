"""Stand-in tables derived from the given TPC-H-ish tables.

The test data holds no weather or tariff tables, so each job runs on a
a SQL expression; Spark evaluates it with ``selectExpr`` and the DuckDB
oracle inlines the same text as a CTE, so both sides read identical inputs.
The true shapes are exercised on the hand-written fixtures in ``tests/``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.sources.tables import load

# Fixed values of the stand-in mapping (own choice, not reference data):
#   tariff        <- customer: active when c_acctbal >= 0,
#                    ready for segments AUTOMOBILE, BUILDING, MACHINERY
#   tariff_domain <- nation: is_personal N for regions 0, 1, 2; T for 3; P else
#   tariff_data   <- orders: active when o_orderstatus = 'O', ready for
#                    priorities 1-URGENT and 2-HIGH, no date_from for 4-NOT SPECIFIED
#   outcomes      <- TARIFF_APPLY: E-1001 when c_acctbal < 1000, W-2002 when > 9000;
#                    APPROVE_DOMAIN: E-3001 when n_nationkey < 10, I-0000 when < 20
#   responses     <- events: status NULL (transport error) for error events
#                    with value < 5, 503 for other error events, else 200
#   status seed   <- supplier: key s_suppkey, location s_name, nothing else set
#   locations     <- nation x region: location "<r_name>/<n_name>", key n_name
#   conditions log <- events: city <user_id>, station <event_id>, weather
#                    <event_type>; wind gust = value, sent as JSON text for
#                    clicks and as a number otherwise; humidity "<floor(value) % 100>%";
#                    precip "-9999.00" for errors; heat index "NA" below 50;
#                    solar radiation "--" for views, else "0"
#   landed chunks <- events: location "L/<user_id>", the 200 responses carry the
#                    body {"current_observation":{"display_location":{"city":
#                    "<user_id>"},"weather":"<event_type>"}} cut into 3 chunks

STANDINS: dict[str, tuple[str, dict[str, str]]] = {
    "tariff": ("customer", {
        "id": "c_custkey",
        "tariff_domain__oid": "CAST(c_nationkey AS BIGINT)",
        "name": "c_name",
        "is_ready": "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN 'Y' ELSE 'N' END",
        "amnd_state": "CASE WHEN c_acctbal >= 0 THEN 'A' ELSE 'C' END",
    }),
    "tariff_domain": ("nation", {
        "id": "CAST(n_nationkey AS BIGINT)",
        "code": "n_name",
        "is_personal": "CASE WHEN n_regionkey IN (0, 1, 2) THEN 'N' WHEN n_regionkey = 3 THEN 'T' ELSE 'P' END",
        "amnd_state": "'A'",
    }),
    "tariff_data": ("orders", {
        "id": "o_orderkey",
        "tariff__oid": "o_custkey",
        "amnd_state": "CASE WHEN o_orderstatus = 'O' THEN 'A' ELSE 'C' END",
        "is_ready": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Y' ELSE 'N' END",
        "date_from": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(NULL AS DATE) ELSE CAST(o_orderdate AS DATE) END",
    }),
    "tariff_apply_result": ("customer", {
        "id": "c_custkey",
        "err_msg": "CASE WHEN c_acctbal < 1000 THEN 'E-1001 balance below limit' "
                   "WHEN c_acctbal > 9000 THEN 'W-2002 balance above review level' END",
    }),
    "approve_domain_result": ("nation", {
        "id": "CAST(n_nationkey AS BIGINT)",
        "err_msg": "CASE WHEN n_nationkey < 10 THEN 'E-3001 template locked' "
                   "WHEN n_nationkey < 20 THEN 'I-0000 approved' END",
    }),
    "responses": ("events", {
        "request_id": "event_id",
        "key": "user_id",
        "status": "CASE WHEN event_type = 'error' AND value < 5 THEN CAST(NULL AS INT) "
                  "WHEN event_type = 'error' THEN 503 ELSE 200 END",
        "data": "event_type",
        "received_at": "ts",
    }),
    "status": ("supplier", {
        "key": "s_suppkey",
        "location": "s_name",
        "data": "CAST(NULL AS STRING)",
        "update_status": "CAST(NULL AS STRING)",
        "last_update": "CAST(NULL AS TIMESTAMP_NTZ)",
    }),
}

# DuckDB spells two of the types differently.
_DUCK_TYPES = {"AS STRING)": "AS VARCHAR)", "AS TIMESTAMP_NTZ)": "AS TIMESTAMP)"}


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, cols = STANDINS[name]
    return load(spark, sf_dir, table).selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])


def standin_cte(name: str) -> str:
    table, cols = STANDINS[name]
    body = ", ".join(f"{e} AS {c}" for c, e in cols.items())
    for spark_t, duck_t in _DUCK_TYPES.items():
        body = body.replace(spark_t, duck_t)
    return f"{name} AS (SELECT {body} FROM {table})"


def with_standins(*names: str) -> str:
    return "WITH " + ",\n".join(standin_cte(n) for n in names)


BODY_CHUNKS = 3


# Fixed values of the broken bodies: every so many-th request, cut before its city.
BROKEN_EVERY, BROKEN_CHARS = 97, 30


def landed_chunks(spark: SparkSession, sf_dir: str, pretty: bool = False, broken: bool = False) -> DataFrame:
    """Landed responses (one row per chunk) built from ``events``.

    Each response with status 200 carries a JSON body cut into
    ``BODY_CHUNKS`` pieces; other responses land as one NULL chunk.
    ``pretty`` spreads the body over many lines, ``broken`` cuts some short.
    """
    from pyspark.sql import functions as F

    r = standin(spark, sf_dir, "responses")
    key = F.col("key").cast("string")
    body = F.to_json(F.struct(F.struct(
        F.struct(key.alias("city")).alias("display_location"),
        F.col("data").alias("weather"),
    ).alias("current_observation")))
    if pretty:
        body = F.concat(F.lit('{\n  "current_observation": {\n    "display_location": {\r\n      "city": "'), key,
                        F.lit('"\n    },\n    "weather": "'), F.col("data"), F.lit('"\n  }\n}\n'))
    if broken:
        body = F.when(F.col("request_id") % BROKEN_EVERY == 0, F.substring(body, 1, BROKEN_CHARS)).otherwise(body)
    with_body = r.select(
        "request_id",
        F.concat(F.lit("L/"), F.col("key").cast("string")).alias("location"),
        "status", "received_at",
        F.when(F.col("status") == 200, body).alias("body"),
    )
    seqs = F.when(F.col("body").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.lit(BODY_CHUNKS - 1)))
    exploded = with_body.select(
        "*", F.explode(seqs).alias("seq"),
        F.ceil(F.length("body") / BODY_CHUNKS).cast("int").alias("_w"),
    )
    return exploded.select(
        "request_id", "location", "status", F.col("seq").cast("int").alias("seq"),
        F.expr("substring(body, 1 + seq * _w, _w)").alias("chunk"),
        F.col("received_at").cast("timestamp").alias("received_at"),
        F.size(seqs).alias("n_chunks"),
    )


def status_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``location -> key`` for the status stand-in (string keys)."""
    from pyspark.sql import functions as F

    s = load(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    return s.select(F.concat(F.lit("L/"), key).alias("location"), key.alias("key"))


def conditions_log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(city, at, body) log records whose bodies mix JSON numbers and text
    and use every missing-value spelling of the feed."""
    from pyspark.sql import functions as F

    e = load(spark, sf_dir, "events")
    v = F.col("value").cast("string")
    kind = F.col("event_type")
    exponent = F.when(v.contains("E"), v).otherwise(F.concat(v, F.lit("e+0")))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    fields = [
        ("station_id", quoted(F.col("event_id").cast("string"))),
        ("observation_epoch", quoted(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))),
        ("weather", quoted(kind)),
        ("temp_f", F.when(kind == "view", exponent).otherwise(v)),
        ("wind_gust_mph", F.when(kind == "click", quoted(v)).when(kind == "view", quoted(exponent)).otherwise(exponent)),
        ("relative_humidity", quoted(F.concat((F.floor("value").cast("long") % 100).cast("string"), F.lit("%")))),
        ("precip_1hr_in", quoted(F.when(kind == "error", F.lit("-9999.00")).otherwise(v))),
        ("heat_index_f", F.when(F.col("value") < 50, F.lit('"NA"')).otherwise(v)),
        ("solarradiation", quoted(F.when(kind == "view", F.lit("--")).otherwise(F.lit("0")))),
    ]
    parts = [F.lit('{"current_observation":{"display_location":{"city":'),
             quoted(F.col("user_id").cast("string")), F.lit("}")]
    for name, token in fields:
        parts += [F.lit(f',"{name}":'), token]
    parts.append(F.lit("}}"))
    return e.select(F.col("user_id").cast("string").alias("city"), F.col("ts").alias("at"),
                    F.concat(*parts).alias("body"))
