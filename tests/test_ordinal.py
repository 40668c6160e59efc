"""The bucketed running total against brute force on small inputs."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from freshet.operators.ordinal import global_row_number, running_total


def test_row_number_many_buckets(spark):
    ids = list(range(0, 3000, 3))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    got = {r.id: r.rnum for r in global_row_number(df, ["id"], n_buckets=13).collect()}
    want = {v: n + 1 for n, v in enumerate(sorted(ids))}
    assert got == want


def test_running_sum_exclusive_string_keys(spark):
    rnd = random.Random(7)
    rows = [(f"k{rnd.randrange(40):02d}", i, rnd.randrange(5)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, i long, v long").repartition(3)
    out = running_total(df, ["g", "i"], value=F.col("v"), out="s", inclusive=False, n_buckets=9)
    got = {(r.g, r.i): r.s for r in out.collect()}
    acc, want = 0, {}
    for g, i, v in sorted(rows):
        want[(g, i)] = acc
        acc += v
    assert got == want


def test_null_keys_sort_first(spark):
    df = spark.createDataFrame([(None,), (5,), (1,), (None,), (3,)], "k long")
    df = df.withColumn("tie", F.monotonically_increasing_id())
    out = running_total(df, ["k", "tie"], n_buckets=4).orderBy("rnum").collect()
    assert [r.k for r in out] == [None, None, 1, 3, 5]
    assert [r.rnum for r in out] == [1, 2, 3, 4, 5]


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long")
    assert global_row_number(df, ["id"]).count() == 0


def test_numeric_key_many_buckets_with_nulls(spark):
    rnd = random.Random(3)
    keys = rnd.sample(range(10**12, 10**12 + 10**7), 5000) + [None, None]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long").repartition(7)
    out = running_total(df.filter(F.col("k").isNotNull()), ["k"], value=F.col("i"), out="s", n_buckets=3000)
    acc, want = 0, {}
    for k, i in sorted((k, i) for i, k in enumerate(keys) if k is not None):
        acc += i
        want[k] = acc
    assert {r.k: r.s for r in out.collect()} == want
    nulls = global_row_number(df, ["k"], n_buckets=50).filter(F.col("k").isNull()).collect()
    assert sorted(r.rnum for r in nulls) == [1, 2]


NAN, INF = float("nan"), float("inf")


def _spark_key(v):
    """Ascending order of Spark: NULL first, NaN after infinity."""
    return (v is not None, v is not None and v != v, 0 if v is None or v != v else v)


@pytest.mark.parametrize("kind, special", [
    ("long", [None, -2**63, 2**63 - 1]), ("double", [None, NAN, INF, -INF, -0.5]),
    ("decimal(20,3)", [None, Decimal("-1.500"), Decimal("0.001")]), ("string", [None, "", "é", "zz"]),
])
@pytest.mark.parametrize("n", [3, 5000])
def test_every_key_type_with_nulls_and_extremes(spark, kind, special, n):
    make = {"long": lambda i: i * 7, "double": lambda i: i / 3, "decimal(20,3)": lambda i: Decimal(i), "string": lambda i: f"k{i:05d}"}[kind]
    keys = (special + [make(i + 2) for i in range(n)])[:max(n, len(special))]
    random.Random(9).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], f"k {kind}").repartition(4)
    got = [r.k for r in global_row_number(df, ["k"]).orderBy("rnum").collect()]
    want = sorted(keys, key=_spark_key)
    assert list(map(_spark_key, got)) == list(map(_spark_key, want))


@pytest.mark.parametrize("n", [3, 5000])
def test_composite_keys(spark, n):
    rows = [(None if i % 7 == 0 else f"g{i % 5}", i) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i long").repartition(4)
    got = [(r.g, r.i) for r in global_row_number(df, ["g", "i"], n_buckets=100).orderBy("rnum").collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.lists(st.integers(-10**6, 10**6), min_size=0, max_size=60, unique=True),
    values=st.lists(st.integers(0, 9), min_size=60, max_size=60),
    n_buckets=st.integers(1, 20),
    parts=st.integers(1, 5),
    inclusive=st.booleans(),
)
def test_running_total_matches_brute_force(spark, keys, values, n_buckets, parts, inclusive):
    rows = [(k, values[i]) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(parts)
    out = running_total(df, ["k"], value=F.col("v"), out="s", inclusive=inclusive, n_buckets=n_buckets)
    acc, want = 0, {}
    for k, v in sorted(rows):
        want[k] = acc + v if inclusive else acc
        acc += v
    assert {r.k: r.s for r in out.collect()} == want
