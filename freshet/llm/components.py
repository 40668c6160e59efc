"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the grouped key, so a vertex
with very many links is pre-aggregated on the map side and its rows can be
split by the skew join; no vertex's neighbours are gathered in one place.
Each round is written to the shared folder, which cuts the lineage and
survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.materialize import materialize


def _state(e: DataFrame) -> tuple[int, int]:
    r = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"] or 0


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b) that is not the
    smallest of its component; label is that smallest node. Self links and
    repeated links are allowed."""
    e = materialize(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
