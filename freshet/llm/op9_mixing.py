"""Mixing sources to target weights by entropy balancing.

Targets: the sources in code point order (null last) weigh 3, 1, 2, repeating,
and share 150 % of all words. A target stops at twice its source's words; what
is over is shared again by weight. Sorted by 2 * words / weight, the level at
which every weight unit ends is the largest of the levels that are left after
capping the first sources.

Rates: among all document rates r >= 0 whose words meet each source's target the
one closest to taking every word once is wanted, in relative entropy weighted
by words. Its dual is convex with one multiplier per source, and the rate is the
exponential tilt r = exp(lambda). Newton's iterations run over the documents'
size cells (source, size, number of documents), staged once: each iteration is
one grouped sum in Spark (gradient and curvature of the dual), its multipliers
are written to the shared folder, and only the largest relative gap reaches the
driver.

Copies: documents are ordered by size within their source, and the k-th gets
floor(r) copies and one more whenever k * frac(r) passes a half. The error in
words is then at most half the largest document's (partial sums of the rounding
are at most a half and the sizes ascend). The document that can give or take
most words ends with part of a copy, which settles that difference.

The rank within a source comes from counts: size buckets, then (size, salt) cells
of a bucket, then a row number within one cell, so no task sorts a whole source.
All of it is DataFrame functions. What has one row per source (targets, rates,
differences) is small; Spark decides by size whether to broadcast it.

Defined cases: null and blank texts have size 0 and are taken 0 times; sources
without words have target 0; repeated rows are ranked one by one; null ids sort
first; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import table
from freshet.operators.materialize import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2  # a document's words are taken at most so many times
WORD = r"[^\x20\x09-\x0D]+"
BUCKET = 16  # sizes that share a bucket
SALTS = 64
TOLERANCE = 1e-10
MAX_ITERATIONS = 60
DIGITS = 9  # of a rate


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each document."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"))


def targets(rows: DataFrame) -> DataFrame:
    """(no, source, source_size, target), one row per source."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("no") - 1) % len(WEIGHTS) + 1).cast("int"))
    # Windows over one row per source.
    listed = sums.withColumn("no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", weight)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "no").rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("source_size").over(by_ratio), F.lit(0)) * LIMIT
    left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))
    level = (F.sum("source_size").over(every) * SHARE - capped) / left
    target = F.least(F.col("source_size") * float(LIMIT), F.col("weight") * F.max("level").over(every))
    return listed.withColumn("level", level).select("no", "source", "source_size", target.alias("target"))


def balance(cells: DataFrame, goals: DataFrame) -> DataFrame:
    """(no, rate): exponential tilts that meet the goals (no, source_size,
    target) over ``cells`` (no, size, n)."""
    state = goals.select("no", "target", F.lit(0.0).alias("lam"))
    for _ in range(MAX_ITERATIONS):
        moment = F.sum(F.col("n") * F.col("size") * F.exp("lam"))
        step = cells.join(state, "no").groupBy("no", "target", "lam").agg(moment.alias("moment"))
        gap = F.when(F.col("moment") > 0, (F.col("moment") - F.col("target")) / F.col("moment")).otherwise(0.0)
        state = materialize(step.select("no", "target", (F.col("lam") - gap).alias("lam"), F.abs(gap).alias("gap")), "dual")
        if (state.agg(F.max("gap")).first()[0] or 0.0) <= TOLERANCE:
            break
        state = state.drop("gap")
    return state.select("no", F.round(F.exp("lam"), DIGITS).alias("rate"))


def _ranked(rows: DataFrame) -> DataFrame:
    """``rank`` of every row in its source, by size, then salt, then doc_id."""
    spread = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(1000003)) * F.lit(2654435761) % F.lit(4294967296)
    salted = rows.withColumn("salt", F.floor(spread / (4294967296 // SALTS)).cast("int")).withColumn("bucket", F.floor(F.col("size") / BUCKET))
    cells = salted.groupBy("no", "bucket", "size", "salt").agg(F.count("*").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = cells.groupBy("no", "bucket").agg(F.sum("n").alias("n")).withColumn("far", before(Window.partitionBy("no").orderBy("bucket")))
    near = cells.withColumn("near", before(Window.partitionBy("no", "bucket").orderBy("size", "salt")))
    offsets = near.join(buckets.select("no", "bucket", "far"), ["no", "bucket"]).select("no", "size", "salt", (F.col("far") + F.col("near")).alias("offset"))
    key = ["no", "size", "salt"]
    inside = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id"))
    return salted.join(offsets, key).withColumn("rank", F.col("offset") + inside).select("doc_id", "no", "size", "rank")


def mix(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, size) with source_size, target and taken."""
    rows = materialize(rows, "sizes")
    goals = materialize(targets(rows), "targets")
    numbered = rows.join(goals.select("no", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "no", "size")
    cells = materialize(numbered.groupBy("no", "size").agg(F.count("*").alias("n")), "cells")
    rates = balance(cells, goals)

    k, part = F.col("rank"), F.col("rate") - F.floor("rate")
    extra = F.floor(k * part + 0.5) - F.floor((k - 1) * part + 0.5)
    copies = F.least(F.floor("rate") + extra, F.lit(LIMIT))
    placed = materialize(_ranked(numbered).join(rates, "no").select("doc_id", "no", "size", "rank", copies.cast("long").alias("copies")), "copies")

    up, down = (LIMIT - F.col("copies")) * F.col("size"), F.col("copies") * F.col("size")
    sums = placed.groupBy("no").agg(
        F.sum(down).alias("words"),
        F.max(F.struct(up.alias("room"), "rank")).alias("up"), F.max(F.struct(down.alias("room"), "rank")).alias("down"),
    )
    off = F.round("target").cast("long") - F.col("words")
    # Written, so its size is known: broadcast if small, else a join that splits hot sources.
    fixes = materialize(goals.join(sums, "no").select(
        "no", "source", "source_size", "target",
        F.when(off > 0, F.col("up.rank")).otherwise(F.col("down.rank")).alias("fix_rank"),
        F.when(off > 0, F.least(off, F.col("up.room"))).otherwise(F.greatest(off, -F.col("down.room"))).alias("fix"),
    ), "fixes")
    taken = F.col("copies") * F.col("size") + F.when(F.col("rank") == F.col("fix_rank"), F.col("fix")).otherwise(0)
    return placed.join(fixes, "no").select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix(sized(docs)).drop("source")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mix of what is left: how many words of which
    document are taken."""
    return mix(sized(docs))


def mix_sql(documents: str, columns: str) -> str:
    """DuckDB SQL for the mix of a relation (doc_id, text, source), with the
    dual's solution target / source_size in place of the iterations."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM {documents}),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
listed AS (
  SELECT *, [3, 1, 2][(no - 1) % 3 + 1] AS weight
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM sums)),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER r, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER r, 0)) AS level
  FROM listed WINDOW r AS (ORDER BY source_size / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (SELECT no, source, source_size, least(2.0::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM levels),
ranked AS (
  SELECT s.doc_id, s.size, g.*, CASE WHEN source_size > 0 THEN round(target / source_size, {DIGITS}) ELSE 1 END AS rate,
         row_number() OVER (PARTITION BY g.no ORDER BY s.size, ((coalesce(doc_id, 0) % 1000003) * 2654435761 % 4294967296) // {4294967296 // SALTS}, doc_id) AS rank
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
copied AS (
  SELECT *, least(floor(rate) + floor(rank * (rate - floor(rate)) + 0.5) - floor((rank - 1) * (rate - floor(rate)) + 0.5), 2)::BIGINT AS copies FROM ranked),
settled AS (
  SELECT *, round(target)::BIGINT - sum(copies * size) OVER (PARTITION BY no) AS off,
         row_number() OVER (PARTITION BY no ORDER BY (2 - copies) * size DESC, rank DESC) AS up,
         row_number() OVER (PARTITION BY no ORDER BY copies * size DESC, rank DESC) AS down
  FROM copied)
SELECT {columns},
       CAST(copies * size + CASE WHEN off > 0 AND up = 1 THEN least(off, (2 - copies) * size)
                                 WHEN off <= 0 AND down = 1 THEN greatest(off, -copies * size) ELSE 0 END AS BIGINT) AS taken
FROM settled"""


QUERIES = {"op9_mixing": op9_mixing}
ORACLE = {"op9_mixing": mix_sql("documents", "doc_id, size, source_size, target")}
