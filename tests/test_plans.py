"""Plan shape checks: pushdown, pruning, no single-task window over the data."""

import datetime as dt

import pytest

from freshet.operators.ordinal import global_row_number
from freshet.plans import renewal
from freshet.session import work_path


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def parquet_tables(spark):
    root = work_path(spark, "plan_tables")
    spark.createDataFrame(
        [(1, 1, "T1", "N", "A"), (2, 1, "T2", "Y", "C")],
        "id long, tariff_domain__oid long, name string, is_ready string, amnd_state string",
    ).write.parquet(f"{root}/tariff")
    spark.createDataFrame([(1, "D1", "N", "A")],
                          "id long, code string, is_personal string, amnd_state string"
                          ).write.parquet(f"{root}/tariff_domain")
    spark.createDataFrame(
        [(10, 1, "A", "N", dt.date(2024, 1, 1)), (11, 1, "C", "Y", None)],
        "id long, tariff__oid long, amnd_state string, is_ready string, date_from date",
    ).write.parquet(f"{root}/tariff_data")
    return tuple(spark.read.parquet(f"{root}/{n}") for n in ("tariff", "tariff_domain", "tariff_data"))


def test_filters_reach_the_scan(parquet_tables):
    t, td, tv = parquet_tables
    plan = _plan(renewal.renewal_candidates(t, td, tv, with_rnum=False))
    assert "EqualTo(amnd_state,A)" in plan
    assert "EqualTo(is_personal,N)" in plan
    # the versions scan reads exactly the columns the job uses
    assert "struct<id:bigint,tariff__oid:bigint,amnd_state:string,is_ready:string,date_from:date>" in plan


def test_versions_reduce_map_side(parquet_tables):
    t, td, tv = parquet_tables
    plan = _plan(renewal.latest_versions(tv))
    assert "partial_max_by" in plan and "partial_count" in plan


def test_ordinal_window_is_partitioned(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    plan = _plan(global_row_number(df, ["k"], n_buckets=8))
    assert "hashpartitioning(_bkt" in plan
    # the only single-partition step is the window over the per-bucket totals
    single = plan.count("SinglePartition")
    assert single <= 1


def test_bucketed_big_table_is_not_shuffled(spark, parquet_tables):
    from freshet.sources.tables import save_bucketed

    t, td, tv = parquet_tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the sort-merge path
    try:
        big = save_bucketed(tv, "tariff_data_bucketed", "id", 4)
        cands = renewal.renewal_candidates(t, td, big, with_rnum=False)
        out = renewal.clear_date_from(big, cands)
        lines = _plan(out).splitlines()
        smj = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        # the bucketed table feeds the join directly: only a sort in between, no exchange
        assert smj < scan and not any("Exchange" in line for line in lines[smj + 1:scan])
        rows = {r.id: r.date_from for r in out.collect()}
        assert set(rows) == {10, 11} and rows[10] is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS tariff_data_bucketed")
