"""Tree paths and running folds against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import scan
from freshet.operators.hierarchy import resolve_paths
from freshet.plans import renewal


def _paths(spark, rows):
    df = spark.createDataFrame(rows, "id long, parent_id long, code string")
    return {r.id: (r.path, r.depth, r.state) for r in resolve_paths(df).collect()}


def _plain(rows):
    nodes, out = {r[0]: r for r in rows if r[0] is not None}, {}
    for i, (_, parent, code) in nodes.items():
        codes, at, seen = [code or ""], parent, {i}
        while at in nodes and at not in seen:
            seen.add(at)
            codes.append(nodes[at][2] or "")
            at = nodes[at][1]
        out[i] = (code or "", None, "cycle") if at in seen else ("/".join(codes[::-1]), len(codes) - 1, "rooted" if at is None else "orphan")
    return out


def test_a_chain_of_a_thousand_levels(spark):
    rows = [(i, i - 1 if i else None, str(i % 10)) for i in range(1000)]
    random.Random(1).shuffle(rows)
    got = _paths(spark, rows)
    assert got == _plain(rows) and got[999][1] == 999


def test_cycles_orphans_and_odd_nodes(spark):
    rows = [(1, None, "top"), (2, 1, None), (3, 2, "c"), (4, 4, "self"), (5, 4, "below self"), (6, 8, "x"), (7, 6, "y"), (8, 7, "z"), (9, 8, "tail"),
            (10, 77, "lost"), (11, 10, "under lost"), (None, 1, "no id"), (-3, 3, "d"), (12, None, "")]
    got = _paths(spark, rows)
    assert got == _plain(rows)
    assert got[3] == ("top//c", 2, "rooted") and got[9] == ("tail", None, "cycle") and got[11] == ("lost/under lost", 1, "orphan")


def test_random_trees_and_no_nodes(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, rng.randrange(200), rng.randrange(i + 1)]), f"c{i}") for i in range(150)]
    assert _paths(spark, rows) == _plain(rows)
    assert _paths(spark, []) == {}


@pytest.mark.parametrize("name", ["SUM", "MAX", "MIN", "LAST", "FIRST"])
def test_running_folds(spark, name):
    fold = getattr(scan, name)
    plain = {"SUM": lambda a, b: a + b, "MAX": max, "MIN": min, "LAST": lambda a, b: b, "FIRST": lambda a, b: a}[name]
    rng = random.Random(name)
    rows = [(k, rng.choice([None, None, rng.randrange(-50, 50)])) for k in range(300)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    for inclusive in (True, False):
        got = {r.k: r.out for r in scan.running_fold(df, ["k"], F.col("v"), fold, "out", inclusive, n_buckets=7).collect()}
        so_far, want = None, {}
        for k, v in sorted(rows):
            after = v if so_far is None else so_far if v is None else plain(so_far, v)
            want[k], so_far = (after if inclusive else so_far), after
        assert got == want


def test_the_error_text_is_carried_to_candidates_without_a_version(spark):
    cands = spark.createDataFrame(
        [(1, 1, "a", "N", 10, "N", None, 1), (2, 1, "b", "N", None, None, None, 2), (3, 1, "c", "N", 30, "N", None, 3), (4, 1, "d", "N", None, None, None, 4),
         (5, 1, "e", "N", 50, "N", None, 5), (6, 9, "f", "N", None, None, None, 6)],
        "t_id long, tariff_domain__oid long, t_name string, t_is_ready string, tv_id long, tv_is_ready string, tv_date_from date, rnum long")
    results = spark.createDataFrame([(1, "E-1"), (2, "E-never applied"), (3, None), (5, "E-5")], "id long, err_msg string")
    domains = spark.createDataFrame([(1, "D")], "id long, code string")
    said = lambda carry: [r.message for r in renewal.tariff_messages(cands, domains, results, carry).orderBy("seq").collect()]
    assert said(False) == ['Approve failed for "D/a": E-1', 'Approve failed for "D/e": E-5']
    # b repeats a's error, d follows an apply that went well, f's domain is not there.
    assert said(True) == ['Approve failed for "D/a": E-1', 'Approve failed for "D/b": E-1', 'Approve failed for "D/e": E-5', 'Approve failed for "/f": E-5']
