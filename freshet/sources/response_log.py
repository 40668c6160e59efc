"""The append-only response log: two text lines per record.

    Successfully get new data for <city> on <Ddd Mmm dd yyyy HH:mm:ss GMT+hhmm> [(zone name)]
    <response body as one line of JSON>

Writing: each micro-batch or job appends its own part files (Spark writers
never share one file handle); the record text is identical.

Reading: the separator between records is a newline followed by the header
prefix, so the text source is told to split records there (``lineSep``).
The reader stays splittable: Hadoop's line reader resolves records that
straddle split boundaries. The first record of each file keeps the prefix,
which the pattern accepts as optional.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the log format.
HEADER_PREFIX = "Successfully get new data for "
HEADER_MIDDLE = " on "
HEADER_TIME_FORMAT = "EEE MMM dd yyyy HH:mm:ss 'GMT'xx"
# Spark refuses the weekday letter when parsing, so the pattern skips it.
HEADER_PARSE_FORMAT = "MMM dd yyyy HH:mm:ss 'GMT'xx"
# The pattern runs on the header line only; the body is the rest of the record.
HEADER_PATTERN = (
    r"^(?:Successfully get new data for )?(.*?) on \w{3} "
    r"(\w{3} \d{2} \d{4} \d{2}:\d{2}:\d{2} GMT[+-]\d{4})"
)


def record_text(city: Column, at: Column, body: Column) -> Column:
    """Header line + newline + body (the writer adds the final newline)."""
    return F.concat(
        F.lit(HEADER_PREFIX), city, F.lit(HEADER_MIDDLE),
        F.date_format(at, HEADER_TIME_FORMAT), F.lit("\n"), body,
    )


def write_response_log(df: DataFrame, path: str, city: Column, at: Column, body: Column,
                       mode: str = "append") -> None:
    df.select(record_text(city, at, body).alias("value")).write.mode(mode).text(path)


def _separated(reader):
    return reader.option("lineSep", "\n" + HEADER_PREFIX)


def read_response_log(spark: SparkSession, path: str) -> DataFrame:
    """Records as (city, logged_at TIMESTAMP, body STRING); bad records keep NULLs."""
    return parse_records(_separated(spark.read).text(path))


def read_response_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The log's records as they land, from all folders below ``path``."""
    reader = _separated(spark.readStream).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_records(reader.text(path))


def parse_records(raw: DataFrame) -> DataFrame:
    v = F.col("value")
    header = F.substring_index(v, "\n", 1)
    # Everything after the header's newline, without the record's final newline.
    rest = v.substr(F.length(header) + 2, F.length(v))
    r = F.col("rest")
    body = F.when(r.endswith("\n"), r.substr(F.lit(1), F.length(r) - 1)).otherwise(r)
    h = F.col("header")
    return (
        raw.filter(F.length(F.trim(v)) > 0)
        .select(header.alias("header"), rest.alias("rest"))
        .select(
            F.nullif(F.regexp_extract(h, HEADER_PATTERN, 1), F.lit("")).alias("city"),
            F.try_to_timestamp(F.regexp_extract(h, HEADER_PATTERN, 2),
                               F.lit(HEADER_PARSE_FORMAT)).alias("logged_at"),
            body.alias("body"),
        )
    )
