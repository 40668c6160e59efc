"""Mixing: targets, limits, rounding and the defined cases."""

import math
from collections import defaultdict

import pytest

from freshet.llm import op9_mixing as op


def water_fill(sizes):
    """Targets by repeated resharing; sizes by source, null key allowed."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * unit > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * unit for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def judge(rows, sizes, slack=1.0):
    want, taken = water_fill(sizes), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack, s


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = defaultdict(int)
    for r in docs.select("source", "text").collect():
        sizes[r["source"]] += len((r["text"] or "").encode().split())
    judge(op.mix(op.sized(docs)).collect(), sizes)


def test_skew_nulls_ties_and_empty_texts(spark):
    rows = [(i, "b", 7) for i in range(900)] + [(i, "a", i % 90) for i in range(300)] + [(5, "Z", 40)] * 30 + [(None, None, 3)] * 20 + [(1, "zero", 0)] * 5 + [(2, "é", 1000)]
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    first = sorted(map(str, op.mix(df).collect()))
    judge(op.mix(df).collect(), sizes)
    assert first == sorted(map(str, op.mix(df.repartition(7)).collect())) and len(first) == len(rows)


def test_word_count_and_empty_table(spark):
    texts = [None, "", " \t\n", "a", "a\x1cb c", "x y z\x0bq"]
    docs = spark.createDataFrame([(i, t, "s", 9) for i, t in enumerate(texts)], "doc_id long, text string, source string, size int")
    assert {r["doc_id"]: r["size"] for r in op.sized(docs).collect()} == {i: len((t or "").encode().split()) for i, t in enumerate(texts)}
    assert op.mix(op.sized(docs.limit(0))).count() == 0
    assert {r["taken"] for r in op.mix(op.sized(docs.where("text is null or text = ''"))).collect()} == {0}


@pytest.mark.parametrize("goal", [0.001, 0.3, 1.0, 1.7, 2.0])
def test_newton_solves_the_dual(spark, goal):
    cells = spark.createDataFrame([(1, 5, 10), (1, 50, 3), (2, 0, 4)], "no int, size long, n long")
    goals = spark.createDataFrame([(1, 200, goal * 200), (2, 0, 0.0)], "no int, source_size long, target double")
    got = {r["no"]: r["rate"] for r in op.balance(cells, goals).collect()}
    assert math.isclose(got[1], goal, abs_tol=1e-8) and got[2] == 1.0
