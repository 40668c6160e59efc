"""Payloads whose fields change type, read as VARIANT.

The feed sends the same field as a JSON number in one response and as text in the
next. A fixed schema has to guess; a variant keeps what was sent, and each field is
taken as text and typed by the sentinel-aware casts. ``field_kinds`` reports what
was sent, so a field that changes its type is seen before it is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.payload import epoch_seconds, number

OBSERVATION = "$.current_observation"
_TEXT = ("station_id", "weather")
_NUMBERS = (
    "temp_f", "temp_c", "wind_mph", "wind_kph", "wind_gust_mph", "wind_gust_kph", "heat_index_f", "heat_index_c", "windchill_f", "windchill_c",
    "relative_humidity", "feelslike_f", "pressure_mb", "visibility_mi", "UV", "precip_1hr_in", "precip_1hr_metric", "precip_today_in", "solarradiation",
)


def variant_body(body: Column) -> Column:
    """JSON text -> variant; a malformed body gives NULL."""
    return F.try_parse_json(body)


def variant_text(v: Column, path: str) -> Column:
    """The value at ``path`` as text, whatever its type; NULL where it is none."""
    return F.try_variant_get(v, path, "string")


def variant_conditions(v: Column) -> list[Column]:
    """Typed, flat columns of one payload, named as in ``typed_conditions``."""
    at = lambda name: variant_text(v, f"{OBSERVATION}.{name}")
    return [at("display_location.city").alias("city"), *[at(n).alias(n) for n in _TEXT],
            epoch_seconds(at("observation_epoch")).alias("observed_at"), *[number(at(n)).alias(n) for n in _NUMBERS]]


def kind_of(value: Column) -> Column:
    """number, text, null, boolean, object or array."""
    kind = F.schema_of_variant(value)
    return (F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), "number").when(kind == "STRING", "text").when(kind == "VOID", "null")
            .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise(F.lower(kind)))


def field_kinds(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(field, kind, n, drifts) over all ``bodies``: how often each field of the
    observation came as each kind, and whether it came as several (a null is no
    kind of its own). Malformed bodies have no fields. One partial aggregate; a row
    per field and kind crosses the network."""
    spark = bodies.sparkSession
    seen = bodies.select(F.try_variant_get(variant_body(F.col(body)), OBSERVATION, "variant").alias("_v")).where("_v is not null")
    each = seen.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select(F.col("key").alias("field"), kind_of(F.col("value")).alias("kind"))
    counts = each.groupBy("field", "kind").agg(F.count("*").alias("n"))
    several = counts.where("kind <> 'null'").groupBy("field").agg((F.count("*") > 1).alias("drifts"))
    return counts.join(several, "field", "left").withColumn("drifts", F.coalesce("drifts", F.lit(False)))
