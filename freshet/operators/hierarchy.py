"""Paths in a parent-child table by pointer doubling.

Every node first points to its parent. In each round a node that has not reached
its top takes over its target's pointer (and, in the second phase, puts the
target's path before its own), so a chain of n levels takes about log2(n) rounds,
each one join on the pointer. A node with very many children is a hot key of that
join on the side that the skew join splits; the other side has one row for it.

1. Pointers alone: who reaches a top, and how far it is. A node still under way
   after log2(number of nodes) + 1 rounds is on a cycle or below one.
2. Paths, for the nodes that reach a top. (On a cycle they would never end.)

Every round's state is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.text import oracle_concat
from freshet.operators.materialize import materialize

ROOTED, ORPHAN, CYCLE = "rooted", "orphan", "cycle"


def _rounds(state: DataFrame, most: int, carried: dict) -> tuple[DataFrame, DataFrame]:
    """(nodes that reached their top, nodes still under way). ``state``: id, up
    (NULL at the top) and the carried columns; ``carried`` says how to put the
    target's value before the own one."""
    state = materialize(state, "hierarchy")
    for _ in range(most):
        open_ = state.where("up is not null")
        if open_.isEmpty():
            break
        target = state.select(F.col("id").alias("_id"), F.col("up").alias("_up"), *[F.col(c).alias(f"_{c}") for c in carried])
        moved = open_.join(target, F.col("up") == F.col("_id")).select(
            "id", F.col("_up").alias("up"), *[join(F.col(f"_{c}"), F.col(c)).alias(c) for c, join in carried.items()])
        state = materialize(state.where("up is null").unionByName(moved), "hierarchy")
    return state.where("up is null"), state.where("up is not null")


def resolve_paths(nodes: DataFrame, separator: str = "/") -> DataFrame:
    """(id, path, depth, state) for every node of ``nodes`` (id, parent_id, code).

    ``path`` joins the codes from the top to the node, ``depth`` counts the steps
    from the top. A node without a parent is a top (``rooted``); so is one whose
    parent is not in the table, and it and all below it are ``orphan``. Nodes on a
    cycle (a node that is its own parent included) or below one are ``cycle``: they
    have no top, so their path is their own code and their depth is NULL. A NULL
    code counts as empty. Ids are unique; rows with a NULL id are left out.
    """
    named = nodes.where("id is not null").select("id", "parent_id", "code")
    ids = named.select(F.col("id").alias("_known"))
    linked = named.join(ids, F.col("parent_id") == F.col("_known"), "left")
    base = materialize(linked.select("id", F.col("_known").alias("up"), (F.col("parent_id").isNotNull() & F.col("_known").isNull()).alias("lost"), "code"), "hierarchy")
    most = ceil(log2(max(2, base.count()))) + 1

    start = base.select("id", "up", F.col("up").isNotNull().cast("long").alias("depth"), "lost")
    done, cyclic = _rounds(start, most, {"depth": lambda above, own: above + own, "lost": lambda above, own: above})
    done = materialize(done.select("id", "depth", "lost"), "hierarchy")

    paths, _ = _rounds(base.join(done.select("id"), "id", "left_semi").select("id", "up", F.coalesce("code", F.lit("")).alias("path")),
                       most, {"path": lambda above, own: oracle_concat(above, F.lit(separator), own)})
    state = F.when(F.col("lost"), ORPHAN).otherwise(ROOTED)
    found = paths.join(done, "id").select("id", "path", "depth", state.alias("state"))
    round_ = cyclic.select("id").join(base, "id").select("id", F.coalesce("code", F.lit("")).alias("path"), F.lit(None).cast("long").alias("depth"), F.lit(CYCLE).alias("state"))
    return found.unionByName(round_)
