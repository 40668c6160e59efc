"""String helpers with the semantics the jobs rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def oracle_concat(*parts: Column) -> Column:
    """``a || b || ...`` where NULL counts as the empty string.

    Spark's ``concat`` returns NULL if any input is NULL; the message texts
    of the renewal job concatenate nullable names and error texts, so each
    part is coalesced to '' first.
    """
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def first_char(c: Column) -> Column:
    """``substr(c, 1, 1)``: the severity / error-code letter of an outcome text."""
    return F.substring(c, 1, 1)


def request_path(api_key: Column, location: Column) -> Column:
    """Path of the conditions request for one location."""
    return F.concat(F.lit("/api/"), api_key, F.lit("/conditions/q/"), location, F.lit(".json"))
