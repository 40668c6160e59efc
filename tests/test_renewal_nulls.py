"""Renewal selection with NULL flags stored in the tables, against the same
SQL run by DuckDB over the same fixture files (three-valued logic check).

Added rows: t30 has a NULL tariff flag and a ready version (NULL OR FALSE:
left out); t31 has a NULL tariff flag and an unready version (NULL OR TRUE:
kept); t32 is ready with a NULL version flag (FALSE OR NULL: left out) and
its version is not cleared (NULL is not 'N').
"""

import datetime as dt

import duckdb
import pytest

from freshet.plans import renewal
from freshet.plans.catalog import RENEWAL_LOGIC_SQL
from freshet.session import work_path
from tests.test_renewal_fixtures import tables  # noqa: F401  (fixture)

D = dt.date


@pytest.fixture(scope="module")
def with_nulls(spark, tables):  # noqa: F811
    t, td, tv, _, _ = tables
    t = t.unionByName(spark.createDataFrame([
        (30, 1, "T30", None, "A"), (31, 1, "T31", None, "A"), (32, 1, "T32", "Y", "A"),
    ], t.schema))
    tv = tv.unionByName(spark.createDataFrame([
        (300, 30, "A", "Y", D(2024, 4, 1)), (310, 31, "A", "N", D(2024, 4, 2)),
        (320, 32, "A", None, D(2024, 4, 3)),
    ], tv.schema))
    root = work_path(spark, "renewal_nulls")
    for name, df in (("tariff", t), ("tariff_domain", td), ("tariff_data", tv)):
        df.write.parquet(f"{root}/{name}")
    con = duckdb.connect()
    for name in ("tariff", "tariff_domain", "tariff_data"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}/*.parquet')")
    return t, td, tv, con


def _sql(con, body):
    return sorted(tuple(r) for r in con.sql("WITH " + RENEWAL_LOGIC_SQL + body).fetchall())


def test_candidates_match_sql(with_nulls):
    t, td, tv, con = with_nulls
    got = sorted(tuple(r) for r in renewal.renewal_candidates(t, td, tv, n_buckets=4).collect())
    want = _sql(con, "SELECT * FROM cands")
    assert got == want
    ids = {r[0] for r in got}
    assert 31 in ids and 30 not in ids and 32 not in ids


def test_template_domains_match_sql(with_nulls):
    t, td, _, con = with_nulls
    got = sorted(tuple(r) for r in renewal.template_domains(t, td).collect())
    assert got == _sql(con, "SELECT * FROM tdm")


def test_updates_match_sql(with_nulls):
    t, td, tv, con = with_nulls
    cands = renewal.renewal_candidates(t, td, tv, with_rnum=False)
    got_t = sorted(tuple(r) for r in renewal.mark_ready(t, cands).collect())
    want_t = _sql(con, """
        SELECT t.id, t.tariff_domain__oid, t.name,
               CASE WHEN c.t_id IS NOT NULL THEN 'Y' ELSE t.is_ready END, t.amnd_state
        FROM tariff t LEFT JOIN (SELECT t_id FROM cands WHERE tv_id IS NULL) c ON c.t_id = t.id""")
    assert got_t == want_t
    got_v = sorted(tuple(r) for r in renewal.clear_date_from(tv, cands).collect())
    want_v = _sql(con, """
        SELECT tv.id, tv.tariff__oid, tv.amnd_state, tv.is_ready,
               CASE WHEN c.tv_id IS NOT NULL THEN NULL ELSE tv.date_from END
        FROM tariff_data tv LEFT JOIN (SELECT tv_id FROM cands
                                       WHERE tv_is_ready = 'N' AND tv_date_from IS NOT NULL) c
          ON c.tv_id = tv.id""")
    assert got_v == want_v
    assert dict((r[0], r[4]) for r in got_v)[320] == D(2024, 4, 3)
