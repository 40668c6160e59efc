"""The conditions payload: schema, JSON parse, sentinel-aware typed columns.

Several fields of the payload change JSON type between observations
(``wind_gust_mph`` is ``0`` in one body and ``"2.5"`` in another) or carry
missing-value sentinels (``"NA"``, ``"--"``, ``""``, ``-9999.00``). With
ANSI mode on, a plain ``cast('NA' as double)`` fails the job and a DOUBLE
field in the ``from_json`` schema turns ``"2.5"`` into NULL. So every
unstable field is declared STRING (the JSON parser keeps a number's text
for a STRING field) and converted afterwards with :func:`number`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The missing-number sentinel of the feed and the RFC 822
# timestamp layout after its "Ddd, " weekday prefix is dropped.
MISSING_NUMBER = -9999.0
RFC822_PATTERN = "d MMM yyyy HH:mm:ss xx"
RFC822_WEEKDAY_PREFIX = 5

# Leading number of a text such as "240 ft", "58%", " 0", "-9999.00 in (..)".
_LEADING_NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"

_S = T.StringType()

_LOCATION = T.StructType([
    T.StructField(n, _S) for n in (
        "full", "city", "state", "state_name", "country", "country_iso3166",
        "zip", "magic", "wmo", "latitude", "longitude", "elevation",
    )
])

_TEXT_FIELDS = (
    "station_id", "observation_time", "observation_time_rfc822", "observation_epoch",
    "local_time_rfc822", "local_epoch", "local_tz_short", "local_tz_long",
    "local_tz_offset", "weather", "temperature_string", "relative_humidity",
    "wind_string", "wind_dir", "wind_gust_mph", "wind_gust_kph", "pressure_mb",
    "pressure_in", "pressure_trend", "dewpoint_string", "heat_index_string",
    "heat_index_f", "heat_index_c", "windchill_string", "windchill_f", "windchill_c",
    "feelslike_string", "feelslike_f", "feelslike_c", "visibility_mi", "visibility_km",
    "solarradiation", "UV", "precip_1hr_string", "precip_1hr_in", "precip_1hr_metric",
    "precip_today_string", "precip_today_in", "precip_today_metric", "icon",
)

CONDITIONS_SCHEMA = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("version", _S),
        T.StructField("termsofService", _S),
        T.StructField("features", T.StructType([T.StructField("conditions", T.IntegerType())])),
    ])),
    T.StructField("current_observation", T.StructType(
        [
            T.StructField("display_location", _LOCATION),
            T.StructField("observation_location", _LOCATION),
            T.StructField("temp_f", T.DoubleType()),
            T.StructField("temp_c", T.DoubleType()),
            T.StructField("wind_degrees", T.IntegerType()),
            T.StructField("wind_mph", T.DoubleType()),
            T.StructField("wind_kph", T.DoubleType()),
            T.StructField("dewpoint_f", T.IntegerType()),
            T.StructField("dewpoint_c", T.IntegerType()),
        ]
        + [T.StructField(n, _S) for n in _TEXT_FIELDS]
    )),
])


def parse_body(body: Column) -> Column:
    """JSON text -> struct; a malformed body gives NULL (PERMISSIVE mode)."""
    return F.from_json(body, CONDITIONS_SCHEMA, {"mode": "PERMISSIVE"})


def to_json_text(c: Column) -> Column:
    """Struct -> JSON text keeping NULL fields (the default drops them)."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def number(text: Column) -> Column:
    """Sentinel-aware text -> DOUBLE.

    Takes the leading number of the trimmed text; no number ("NA", "--",
    "") and the feed's -9999 sentinel give NULL. Never raises.
    """
    lead = F.regexp_extract(F.trim(text.cast("string")), _LEADING_NUMBER, 0)
    value = lead.try_cast("double")
    return F.when(value == F.lit(MISSING_NUMBER), F.lit(None).cast("double")).otherwise(value)


def epoch_seconds(text: Column) -> Column:
    """"1472435913" -> TIMESTAMP."""
    return F.timestamp_seconds(text.try_cast("bigint"))


def rfc822(text: Column) -> Column:
    """"Tue, 03 Mar 2020 07:05:09 +0100" -> TIMESTAMP (NULL if unparsable)."""
    return F.try_to_timestamp(
        F.substring(text, RFC822_WEEKDAY_PREFIX + 1, 64), F.lit(RFC822_PATTERN)
    )


def typed_conditions(parsed: Column) -> list[Column]:
    """Typed, flat columns of one parsed payload (``parsed`` is the struct)."""
    co = parsed["current_observation"]
    dl, ol = co["display_location"], co["observation_location"]
    cols = [
        dl["city"].alias("city"),
        dl["full"].alias("full_name"),
        dl["state"].alias("state"),
        dl["country"].alias("country"),
        number(dl["latitude"]).alias("latitude"),
        number(dl["longitude"]).alias("longitude"),
        number(dl["elevation"]).alias("elevation"),
        number(ol["elevation"]).alias("station_elevation_ft"),
        co["station_id"].alias("station_id"),
        co["weather"].alias("weather"),
        co["wind_dir"].alias("wind_dir"),
        epoch_seconds(co["observation_epoch"]).alias("observed_at"),
        epoch_seconds(co["local_epoch"]).alias("local_at"),
        rfc822(co["observation_time_rfc822"]).alias("observed_at_rfc822"),
        co["temp_f"].alias("temp_f"),
        co["temp_c"].alias("temp_c"),
        co["wind_mph"].alias("wind_mph"),
        co["wind_kph"].alias("wind_kph"),
        co["wind_degrees"].alias("wind_degrees"),
        co["dewpoint_f"].alias("dewpoint_f"),
        co["dewpoint_c"].alias("dewpoint_c"),
    ]
    for name in (
        "wind_gust_mph", "wind_gust_kph", "heat_index_f", "heat_index_c",
        "windchill_f", "windchill_c", "relative_humidity", "feelslike_f",
        "pressure_mb", "visibility_mi", "UV", "precip_1hr_in", "precip_1hr_metric",
        "precip_today_in", "solarradiation",
    ):
        cols.append(number(co[name]).alias(name))
    return cols
