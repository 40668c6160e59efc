"""Approximate nearest neighbours with a robust-pruned directed graph.

Vectors are dealt by a hash of their id to shards; every row is indexed. A shard
has ``SHARD`` rows, and more where the table would need over ``SHARDS`` of them (up
to ``MOST``, which bounds a task's memory), since every query goes to every shard.
Equal vectors of a shard are one node that lists their ids in order: as nodes of
their own they would prune each other's edges.

Inside a shard rows are cut by length into bands: the longest of a band is at most
``RATIO`` times the shortest. A band's graph is built in batches: greedy searches
from the medoid propose neighbours for each row, robust pruning keeps the nearest
and drops those that a kept one is closer to by the factor ``ALPHA``; kept edges
are added backwards and overfull nodes are pruned again. Edges are therefore
diverse and lead far as well as near.

The largest inner product is searched as a smallest distance: one more component,
sqrt(M * M - |x| * |x|) with M the band's largest norm, gives all rows one norm, so
the order by distance to a query (whose extra component is 0) is the order by inner
product. Where lengths differ much, this puts rows far apart on the added component
and queries far from all of them, and edges between near rows no longer lead to the
rows a query wants; hence the bands. Lengths are divided by M, so that the graph's
single precision holds for any scale.

Queries are a stated set of rows against all rows: they go to every shard, in
blocks of ``QUERY_BLOCK``; a beam search gives each band's best nodes, longest band
first, and a band that cannot reach the results so far (by its M) is passed over.
How wide the beam has to be is measured when a shard is built: ``PROBES`` of its
rows search, against brute force on the shard, with one of ``BEAMS`` after the other
until ``RECALL`` is met; the last resort is a beam as wide as the band, which sees
all of it. Hits are rescored in double precision on the original vectors and
expanded by their smallest ids, as many as can be asked for; a last step ranks the
shards' candidates. A task holds one shard and one block.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null id, take no part; vectors of another length
than a query's are no candidates of it; equal scores go to the smaller id; fewer
candidates than asked for are all returned; an empty table gives an empty
result. A repeated id is a row of its own; a row is no candidate of a query
with its id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import table
from freshet.operators.materialize import materialize

NEAREST = 20
QUERY_EVERY = 20
SHARD, SHARDS, MOST = 8_192, 64, 131_072
QUERY_BLOCK = 16_384
DEGREE, ALPHA = 32, 1.2
BUILD_BEAM = 64
RATIO = 1.25
BEAMS, RECALL, PROBES = (48, 96, 192, 384, 768), 0.98, 64
TASKS_PER_GROUP = 2  # fewer groups meet in a task by their hash
_BATCH = 256  # rows that search together
_WIDTH = 4  # nodes a search expands at once


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): rows that take part, as doubles."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", v.alias("v")).where("vec_id is not null and v is not null")
    return rows.where(~bad & F.exists("v", lambda x: x != 0))


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths, without overflow or underflow on the way."""
    top = np.abs(x).max(axis=1)
    return top * np.linalg.norm(x / top[:, None], axis=1)


def _augmented(x: np.ndarray) -> np.ndarray:
    """Rows of one band, scaled to length 1 by one more component."""
    x = x / norms(x).max()
    return np.concatenate([x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))[:, None]], axis=1).astype(np.float32)


def bands(x: np.ndarray, ratio: float = RATIO) -> list[np.ndarray]:
    """Rows by length, longest first, cut where the longest of a band is more
    than ``ratio`` times the row's length."""
    size = norms(x)
    order, cuts, top = np.argsort(-size, kind="stable"), [], None
    for i, n in enumerate(size[order]):
        if top is None or top > ratio * n:
            cuts.append(i)
            top = n
    return np.split(order, cuts[1:])


def _distance(points: np.ndarray, size: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances, less the query's own square, of q[i] to points[ids[i]]."""
    return size[ids] - 2 * np.matmul(points[ids], q[:, :, None])[:, :, 0]


def beam_search(points: np.ndarray, size: np.ndarray, graph: np.ndarray, start: int, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest found per query (ids, distances), nearest first,
    ids -1 where there are fewer. graph: node to neighbours, -1 for none."""
    n, b = len(points), len(q)
    row = np.arange(b)[:, None]
    seen = np.zeros((b, n + 1), bool)
    seen[:, [start, n]] = True
    ids = np.full((b, width), n)
    dist = np.full((b, width), np.inf, np.float32)
    done = np.ones((b, width), bool)
    ids[:, 0], done[:, 0] = start, False
    dist[:, 0] = _distance(points, size, q, ids[:, :1])[:, 0]
    live = np.arange(b)
    while len(live):
        r = np.arange(len(live))[:, None]
        open_ = np.where(done[live], np.inf, dist[live])
        pick = np.argpartition(open_, min(_WIDTH, width - 1), axis=1)[:, :_WIDTH]
        ok = np.isfinite(open_[r, pick])
        node = np.where(ok, ids[live][r, pick], n)
        done[live[:, None], pick] = True
        near = np.where(node[:, :, None] < n, graph[np.minimum(node, n - 1)], -1).reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[seen[live[:, None], near]] = n
        seen[live[:, None], near] = True
        fresh = near < n
        keep = max(1, int(fresh.sum(axis=1).max()))
        near = np.take_along_axis(near, np.argsort(~fresh, axis=1, kind="stable")[:, :keep], axis=1)
        d = np.where(near < n, _distance(points, size, q[live], np.minimum(near, n - 1)), np.inf)
        all_d = np.concatenate([dist[live], d], axis=1)
        order = np.argpartition(all_d, width - 1, axis=1)[:, :width]
        dist[live] = all_d[r, order]
        ids[live] = np.concatenate([ids[live], near], axis=1)[r, order]
        done[live] = np.concatenate([done[live], near >= n], axis=1)[r, order]
        live = live[(~done[live]).any(axis=1)]
    order = np.argsort(dist, axis=1, kind="stable")
    return np.where(np.isfinite(dist), ids, -1)[row, order], dist[row, order]


def robust_prune(points: np.ndarray, own: np.ndarray, ids: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours (-1 for none) of each row ``own``
    among its candidates ``ids`` (-1 for none)."""
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    ids[ids == own[:, None]] = -1
    cand = points[np.maximum(ids, 0)]
    d = ((cand - points[own][:, None, :]) ** 2).sum(axis=2)
    d[ids < 0] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    ids, d, cand = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1), np.take_along_axis(cand, order[:, :, None], 1)
    size = (cand * cand).sum(axis=2)
    out, row = np.full((len(own), degree), -1), np.arange(len(own))
    left = d.copy()
    for k in range(degree):
        best = left.argmin(axis=1)
        has = np.isfinite(left[row, best])
        if not has.any():
            break
        out[has, k] = ids[row, best][has]
        chosen = cand[row, best]
        between = size + size[row, best][:, None] - 2 * np.matmul(cand, chosen[:, :, None])[:, :, 0]
        left[alpha * alpha * between <= d] = np.inf
        left[row, best] = np.inf
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM, seed: int = 10) -> tuple[np.ndarray, int]:
    """Neighbours of every row of ``x`` and the node where searches start."""
    points = _augmented(x)
    n, size = len(points), (points * points).sum(axis=1)
    rng = np.random.default_rng(seed)
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    graph = rng.integers(0, n, (n, degree))
    graph[graph == np.arange(n)[:, None]] = -1
    order = rng.permutation(n)
    for at in range(0, n, _BATCH):
        own = order[at:at + _BATCH]
        found, _ = beam_search(points, size, graph, start, points[own], min(beam, n))
        graph[own] = robust_prune(points, own, np.concatenate([found, graph[own]], axis=1), degree, alpha)
        # Edges backwards; what no longer fits is pruned.
        to, frm = graph[own].ravel(), np.repeat(own, degree)
        use = to >= 0
        to, frm = to[use], frm[use]
        by = np.argsort(to, kind="stable")
        to, frm = to[by], frm[by]
        node, first, many = np.unique(to, return_index=True, return_counts=True)
        for a in range(0, len(node), 4 * _BATCH):
            part, start_at, count = node[a:a + 4 * _BATCH], first[a:a + 4 * _BATCH], many[a:a + 4 * _BATCH]
            back = np.full((len(part), int(count.max())), -1)
            slot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            back[np.repeat(np.arange(len(part)), count), slot] = frm[start_at[0]:start_at[0] + count.sum()]
            both = np.sort(np.concatenate([graph[part], back], axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            full = (both >= 0).sum(axis=1) > degree
            graph[part[~full]] = np.sort(both[~full], axis=1)[:, -degree:]
            if full.any():
                graph[part[full]] = robust_prune(points, part[full], both[full], degree, alpha)
    return graph, start


class Band:
    """A band's rows ``x`` with their graph, ready to be searched."""

    def __init__(self, x: np.ndarray, graph: np.ndarray, start: int):
        self.x, self.graph, self.start, self.most = x, graph, start, float(norms(x).max())
        self.points = _augmented(x)
        # All points have length 1: their squares do not change the order.
        self.size = np.zeros(len(x), np.float32)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows or -1, inner products or -inf) of the best found per query."""
        # The order does not depend on a query's length, the precision does.
        flat = np.concatenate([q / norms(q)[:, None], np.zeros((len(q), 1))], axis=1).astype(np.float32)
        found, _ = beam_search(self.points, self.size, self.graph, self.start, flat, min(len(self.x), beam))
        # Summed row by row, so that equal vectors score the same in every shard.
        score = (self.x[np.maximum(found, 0)] * q[:, None, :]).sum(axis=2)
        return found, np.where(found >= 0, score, -np.inf)


def _measured_beam(x: np.ndarray, parts: list[Band], nearest: int, seed: int = 20) -> int:
    """The first of ``BEAMS`` that finds enough of what brute force finds."""
    q = x[np.random.default_rng(seed).permutation(len(x))[:PROBES]]
    exact = (q @ x.T).astype(np.float64)
    k = min(nearest, len(x))
    least = -np.partition(-exact, k - 1, axis=1)[:, k - 1]
    for beam in BEAMS:
        scores = np.concatenate([band.search(q, max(beam, nearest + 1))[1] for band in parts], axis=1)
        slack = 1e-12 * np.abs(exact).max(axis=1)
        if np.minimum((scores >= (least - slack)[:, None]).sum(axis=1), k).mean() >= RECALL * k:
            return beam
    return len(x)


def index_shard(x: np.ndarray, nearest: int) -> pd.DataFrame:
    """The graphs of a shard's distinct vectors ``x``: a row for each (row, its
    place in ``x``; band, at, near, start, beam)."""
    out, parts = [], []
    for i, rows in enumerate(bands(x)):
        graph, start = build_graph(x[rows])
        parts.append(Band(x[rows], graph, start))
        out.append(pd.DataFrame({"row": rows, "band": i, "at": np.arange(len(rows)), "near": [g[g >= 0] for g in graph], "start": start}))
    return pd.concat(out).assign(beam=_measured_beam(x, parts, nearest))


def shard_rows(rows: int) -> int:
    return min(MOST, max(SHARD, -(-rows // SHARDS)))


def build_index(spark: SparkSession, vectors: DataFrame, rows: int | None = None, nearest: int = NEAREST) -> DataFrame:
    """The written index: (shard, dims, band, vec_ids, v, at, near, start, beam) for
    every distinct vector of a shard of ``vectors`` (vec_id, v); vec_ids are its
    rows' ids in order, at is its place in the band, near the places its edges
    lead to, beam what the shard needs. A shard holds vectors of one length."""
    n = vectors.count()
    shards = max(1, -(-n // (rows or shard_rows(n))))
    keyed = vectors.withColumn("dims", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    # A shard is small but takes long: a task for each, not merged by size.
    keyed = keyed.repartitionByRange(shards, "shard", "dims")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        x = np.stack(pdf["v"].tolist()).astype(np.float64)
        _, first, of, many = np.unique(x, axis=0, return_index=True, return_inverse=True, return_counts=True)
        vec_ids = np.split(pdf["vec_id"].to_numpy()[np.argsort(of, kind="stable")], np.cumsum(many)[:-1])
        order = np.argsort(first)
        found = index_shard(x[first[order]], nearest)
        nodes = pdf.iloc[first[order]][["v", "dims", "shard"]].iloc[found["row"]].reset_index(drop=True)
        ids = [vec_ids[order[r]] for r in found["row"]]
        return nodes.join(found.drop(columns="row").reset_index(drop=True)).assign(vec_ids=ids)

    schema = "vec_ids array<long>, v array<double>, dims int, shard int, band int, at int, near array<int>, start int, beam int"
    return materialize(keyed.groupBy("shard", "dims").applyInPandas(build, schema), "ann-index")


_HITS = "query_id long, vec_id long, score double"


def _read_band(index: pd.DataFrame) -> tuple[Band, np.ndarray, np.ndarray, np.ndarray]:
    """The band, its ids in one list, and where each node's ids are and how many."""
    index = index.sort_values("at")
    graph = np.full((len(index), DEGREE), -1)
    for i, near in enumerate(index["near"]):
        graph[i, :len(near)] = near
    held = [np.asarray(ids) for ids in index["vec_ids"]]
    many = np.array(list(map(len, held)))
    return Band(np.stack(index["v"].tolist()).astype(np.float64), graph, int(index["start"].iloc[0])), np.concatenate(held), np.cumsum(many) - many, many


def _expanded(found: np.ndarray, score: np.ndarray, qid: np.ndarray, ids: np.ndarray, first: np.ndarray, many: np.ndarray, nearest: int) -> pd.DataFrame:
    """A row for each id of the nodes found; a node gives as many of its smallest
    ids as can be asked for. A query's own id is no hit, however often a node has it."""
    own = np.unique(ids, return_counts=True)[1].max()
    take = np.where((found >= 0) & np.isfinite(score), np.minimum(many, nearest + own)[found], 0).ravel()
    asked = np.repeat(np.arange(len(found)).repeat(found.shape[1]), take)
    id_ = ids[np.repeat(first[found].ravel() + take - np.cumsum(take), take) + np.arange(take.sum())]
    hit = pd.DataFrame({"asked": asked, "query_id": qid[asked], "vec_id": id_, "score": np.repeat(score.ravel(), take)})
    return hit[hit["query_id"] != hit["vec_id"]]


def _search_block(index: pd.DataFrame, queries: pd.DataFrame, nearest: int, beam: int | None) -> pd.DataFrame:
    if not len(index) or not len(queries):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
    width = max(beam or int(index["beam"].iloc[0]), nearest + 1)
    parts = [_read_band(rows) for _, rows in index.groupby("band")]  # longest first
    qid, q = queries["query_id"].to_numpy(), np.stack(queries["v"].tolist()).astype(np.float64)
    out = []
    for a in range(0, len(q), _BATCH):
        part, part_id = q[a:a + _BATCH], qid[a:a + _BATCH]
        length, least, best = norms(part), np.full(len(part), -np.inf), None
        for band, ids, first, many in parts:
            may = np.flatnonzero(length * band.most * (1 + 1e-9) >= least)
            if not len(may):
                continue
            found, score = band.search(part[may], width)
            hit = _expanded(found, score, part_id[may], ids, first, many, nearest)
            best = pd.concat([best, hit.assign(asked=may[hit["asked"]])])
            best = best.iloc[np.lexsort((best["vec_id"], -best["score"], best["asked"]))]
            best = best[best.groupby("asked").cumcount() < nearest]
            full = best.groupby("asked")["score"].agg(["size", "min"]).query("size == @nearest")
            least[full.index] = full["min"]
        out.append(best.drop(columns="asked"))
    return pd.concat(out)


def search(spark: SparkSession, index: DataFrame, queries: DataFrame, nearest: int = NEAREST, beam: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row of ``queries`` (query_id,
    v), which go to every shard in blocks. ``beam`` overrides what was measured."""
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    tasks = TASKS_PER_GROUP * n_blocks * ((index.agg(F.max("shard")).first()[0] or 0) + 1)
    blocks = F.lit(n_blocks)
    shards = index.select(F.col("shard").alias("s"), F.col("dims").alias("d")).distinct()
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), blocks).cast("int"))
    # A shard meets each block of the stated query set; pairs are (shard, block).
    asked = asked.join(shards, F.size("v") == F.col("d")).select("s", "d", "block", "query_id", "v")
    held = index.select(F.col("shard").alias("s"), F.col("dims").alias("d"), "band", "at", "vec_ids", "v", "near", "start", "beam",
                        F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)).alias("block"))
    keys = ["s", "d", "block"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _search_block(left, right, nearest, beam)

    hits = held.repartition(tasks, *keys).groupBy(*keys).cogroup(asked.repartition(tasks, *keys).groupBy(*keys)).applyInPandas(run, _HITS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    queries = rows.where(F.col("vec_id") % QUERY_EVERY == 0).select(F.col("vec_id").alias("query_id"), "v")
    return search(spark, build_index(spark, rows), queries)


QUERIES = {"op10_ann": op10_ann}
