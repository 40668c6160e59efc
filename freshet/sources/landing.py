"""Landed responses: the table a poller (outside this repo) fills.

One row per received chunk; a response is the chunks of one ``request_id``
in ``seq`` order. ``status`` is the HTTP status, NULL for a transport
error (no response at all). ``n_chunks`` is how many chunks the response
has; a stream holds a response back until it has them all. NULL means the
poller does not know, and the response counts as whole when it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RESPONSE_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("location", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("chunk", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("n_chunks", T.IntegerType()),
])

LOCATION_SCHEMA = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("key", T.StringType()),
])

STATUS_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("update_status", T.StringType()),
    T.StructField("last_update", T.TimestampType()),
])


def read_landed(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(RESPONSE_SCHEMA).format(fmt).load(path)


def read_landed_stream(spark: SparkSession, path: str, fmt: str = "json",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RESPONSE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
