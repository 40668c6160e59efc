"""Failed tasks are retried and give the same numbers.

    python tools/retry_check.py [sf_dir]

Runs in ``local[4,4]`` (four attempts per task). A filter that keeps every
row fails the first attempt of every task in the stages it runs in, so each
of those tasks is recomputed; the global ordinal and the renewal candidates
must equal a clean run.
"""

from __future__ import annotations

import os
import sys

import pandas as pd  # module level: the pandas UDF's string type hints resolve here

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pyspark import TaskContext
    from pyspark.sql import functions as F

    from freshet.operators.ordinal import global_row_number
    from freshet.plans import renewal
    from freshet.plans.standins import standin
    from freshet.session import build_session
    from freshet.sources.tables import load

    spark = build_session(master="local[4,4]", shuffle_partitions=8)

    @F.pandas_udf("boolean")
    def keep_but_fail_first_attempt(s: pd.Series) -> pd.Series:
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return pd.Series([True] * len(s))

    def flaky(df, col):
        return df.filter(keep_but_fail_first_attempt(F.col(col)))

    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    clean = sorted(tuple(r) for r in global_row_number(orders, ["o_orderkey"]).collect())
    retried = sorted(tuple(r) for r in global_row_number(flaky(orders, "o_orderkey"), ["o_orderkey"]).collect())

    t, td, tv = (standin(spark, sf_dir, n) for n in ("tariff", "tariff_domain", "tariff_data"))
    clean_c = sorted(tuple(r) for r in renewal.renewal_candidates(t, td, tv).collect())
    retried_c = sorted(tuple(r) for r in renewal.renewal_candidates(t, td, flaky(tv, "id")).collect())
    ok = clean == retried and clean_c == retried_c
    print(f"ordinal rows {len(clean)} equal after retries: {clean == retried}; "
          f"candidates rows {len(clean_c)} equal after retries: {clean_c == retried_c}")
    spark.stop()
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
