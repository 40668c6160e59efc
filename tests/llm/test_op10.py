"""Nearest neighbours against brute force: recall, scores and order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import op10_ann as op


def brute(ids, x, nearest=20):
    """Per query id (divisible by 20) its (vec_id, score), nearest first."""
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % 20 == 0:
            s = x @ q
            order = np.lexsort((ids, -s))
            out[i] = [(int(ids[j]), s[j]) for j in order if ids[j] != i][:nearest]
    return out


def check(rows, want, least):
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    hits = sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    assert hits >= least * sum(map(len, want.values()))
    for q, found in got.items():
        assert len(found) == len(want[q]) and found == sorted(found, key=lambda f: (-f[1], f[0]))
        true = dict(want[q])
        assert all(np.isclose(s, true[v], rtol=1e-12, atol=1e-15) for v, s in found if v in true)


@pytest.mark.parametrize("shard", [8_192, 150])
def test_given_embeddings(spark, monkeypatch, shard):
    monkeypatch.setattr(op, "SHARD", shard)
    monkeypatch.setattr(op, "QUERY_BLOCK", 16)
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    v = op.valid(spark.read.parquet(f"{sf}/embeddings.parquet"))
    got = op.search(spark, op.build_index(spark, v, shard), v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v"))
    check(got.collect(), brute(ids, x), 0.95)
    if shard > 500:
        check(op.op10_ann(spark, sf).collect(), brute(ids, x), 0.95)


def test_unequal_norms_and_copies(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 16)) * rng.gamma(2, 2, (1500, 1))
    x[300:400] = x[300]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, v array<double>")
    got = op.search(spark, op.build_index(spark, df), df.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v"))
    want = brute(np.arange(1500), x)
    check(got.where("query_id < 300 or query_id >= 400").collect(), {q: w for q, w in want.items() if not 300 <= q < 400}, 0.9)


def _unequal(kind, n=1500, d=64):
    rng = np.random.default_rng(len(kind))
    x = rng.standard_normal((n, d))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "tight clusters":
        return rng.standard_normal((20, d))[rng.integers(0, 20, n)] + 1e-5 * x
    x = x if kind.startswith("gaussian") else unit * np.exp(0.3 * rng.standard_normal((n, 1))) if kind == "log-normal" else unit
    if kind.endswith("one long row"):
        x[7] *= 1e4
    return x * {"gaussian, huge": 1e150, "unit, tiny": 1e-150}.get(kind, 1)


@pytest.mark.parametrize("kind", ["unit", "unit, tiny", "log-normal", "gaussian", "gaussian, huge", "unit, one long row", "gaussian, one long row", "tight clusters"])
def test_recall_on_vectors_of_unequal_length(kind):
    x = _unequal(kind)
    index = op.index_shard(x, 20)
    frame = index.assign(v=list(x[index["row"]]), vec_ids=[[r] for r in index["row"]])
    asked = np.arange(0, len(x), 20)
    got = op._search_block(frame, op.pd.DataFrame({"query_id": asked, "v": list(x[asked])}), 20, None)
    hits = 0
    for q, w in brute(np.arange(len(x)), x).items():
        mine = got[got["query_id"] == q]
        assert len(mine) == 20 and q not in set(mine["vec_id"])
        hits += (mine["score"] >= w[-1][1] - 1e-12 * abs(w[0][1])).sum()
    assert hits >= 0.95 * 20 * len(asked)


@pytest.mark.parametrize("shard", [8_192, 400])
def test_gaussian_vectors_with_one_long_row(spark, shard):
    x = _unequal("gaussian, one long row")
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, v array<double>")
    got = op.search(spark, op.build_index(spark, df, shard), df.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v"))
    check(got.collect(), brute(np.arange(len(x)), x), 0.95)


def test_bands_and_the_beam_that_was_measured():
    x = np.array([[3.0], [1.0], [2.0], [1.0], [2.5]])
    assert [b.tolist() for b in op.bands(x, 1.25)] == [[0, 4], [2], [1, 3]]
    assert op.shard_rows(10) == op.SHARD and op.shard_rows(10**6) == 15_625 and op.shard_rows(10**12) == op.MOST


@pytest.mark.parametrize("shard", [8_192, 500])
def test_queries_inside_groups_of_copies(spark, shard):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for a, n in ((100, 50), (300, 200), (1000, 660)):
        x[a:a + n] = x[a]
    rows = [(i, r.tolist()) for i, r in enumerate(x)]
    rows += [(320, x[320].tolist())] * 30  # a query's own id on more rows than are asked for
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    queries = df.distinct().where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v")
    got = op.search(spark, op.build_index(spark, df, shard), queries).collect()
    inside = [q for a, n in ((100, 50), (300, 200), (1000, 660)) for q in range(a, a + n) if q % 20 == 0]
    for q in inside:
        s = (np.array([v for _, v in rows]) * x[q]).sum(axis=1)
        ids = np.array([i for i, _ in rows])
        want = [int(ids[j]) for j in np.lexsort((ids, -s)) if ids[j] != q][:20]
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (7, [0.5, 0.5]), (8, [0.5, 0.0]), (9, [0.5, 1.0]), (20, [1.0, 2.0, 3.0]), (40, [3.0, 2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    v = op.valid(df)
    q = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v")
    got = [tuple(r) for r in op.search(spark, op.build_index(spark, v), q).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 0.5), (0, 2, 8, 0.5), (0, 3, 9, 0.5), (20, 1, 40, 10.0), (40, 1, 20, 10.0)]


def test_empty_table(spark):
    v = op.valid(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert op.search(spark, op.build_index(spark, v), v.select(F.col("vec_id").alias("query_id"), "v")).count() == 0


def test_robust_prune_keeps_the_nearest_and_the_diverse():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [5, 0]], np.float32)
    kept = op.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, -1, 1]]), 3, 1.2)
    assert kept.tolist() == [[1, 3, -1]]
