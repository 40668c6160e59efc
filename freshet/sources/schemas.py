"""Declared schemas of the renewal tables and a conforming projection.

No DDL exists for these tables; the types follow their use (ids are
integers, flags are one-letter strings, dates are dates). ``conform``
selects the declared columns by name and casts them, so a source table
with extra columns or other integer widths feeds the jobs unchanged, and a
missing column fails before any work starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _S, _D = T.LongType(), T.StringType(), T.DateType()

TARIFF = T.StructType([
    T.StructField("id", _L), T.StructField("tariff_domain__oid", _L), T.StructField("name", _S),
    T.StructField("is_ready", _S), T.StructField("amnd_state", _S),
])
TARIFF_DOMAIN = T.StructType([
    T.StructField("id", _L), T.StructField("code", _S), T.StructField("is_personal", _S),
    T.StructField("amnd_state", _S),
])
TARIFF_DATA = T.StructType([
    T.StructField("id", _L), T.StructField("tariff__oid", _L), T.StructField("amnd_state", _S),
    T.StructField("is_ready", _S), T.StructField("date_from", _D),
])
LOCAL_CONSTANTS = T.StructType([T.StructField("date_from", _D), T.StructField("date_to", _D)])
# Outcome of an opaque apply / approve call per id (NULL: no message).
OUTCOME = T.StructType([T.StructField("id", _L), T.StructField("err_msg", _S)])
# The status table; documents exported from the original store name two
# fields in camelCase, accepted as aliases.
STATUS = T.StructType([
    T.StructField("key", _S), T.StructField("location", _S), T.StructField("data", _S),
    T.StructField("update_status", _S), T.StructField("last_update", T.TimestampType()),
])
STATUS_ALIASES = {"update_status": ("updateStatus",), "last_update": ("lastUpdate",)}


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False,
            aliases: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Declared columns, by name (case-insensitive, or one of ``aliases``),
    cast to the declared types (ANSI casts)."""
    have = {c.lower(): c for c in df.columns}
    aliases = aliases or {}
    source = {}
    for f in schema.fields:
        for name in (f.name, *aliases.get(f.name, ())):
            if name.lower() in have:
                source[f.name] = have[name.lower()]
                break
    missing = [f.name for f in schema.fields if f.name not in source]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    cols = [F.col(source[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    if keep_extra:
        used = {c.lower() for c in source.values()}
        cols += [F.col(c) for c in df.columns if c.lower() not in used]
    return df.select(*cols)


def conform_status(df: DataFrame) -> DataFrame:
    """The five declared columns for reading; never what gets published."""
    return conform(df, STATUS, aliases=STATUS_ALIASES)


def status_names(df: DataFrame) -> dict[str, str]:
    """Declared column -> the name ``df`` has for it."""
    have = {c.lower(): c for c in df.columns}
    spellings = {f.name: (f.name, *STATUS_ALIASES.get(f.name, ())) for f in STATUS.fields}
    found = {n: next((have[s.lower()] for s in ss if s.lower() in have), None) for n, ss in spellings.items()}
    missing = [n for n, c in found.items() if not c]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return found
