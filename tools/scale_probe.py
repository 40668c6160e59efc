"""Time the flagship and the global ordinal on k-fold copies of the tables.

    python tools/scale_probe.py [sf_dir] [k ...]

``customer`` and ``orders`` are replicated k times by Spark (ids offset per
copy, so every copy is a new set of tariffs with their own versions) and
written once to a scratch folder below ``spark.checkpoint.dir``; then the
renewal candidates and the global ordinal over all versions are timed on
each size. Near-linear growth of the time with k is the expected shape.
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def replicate(spark, sf_dir, k, out):
    from pyspark.sql import functions as F

    from freshet.sources.tables import load

    copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
    cust = load(spark, sf_dir, "customer")
    orders = load(spark, sf_dir, "orders")
    span_c = cust.agg(F.max("c_custkey")).first()[0] + 1
    span_o = orders.agg(F.max("o_orderkey")).first()[0] + 1
    cust.select("*", copies).select(
        (F.col("c_custkey") + F.col("_copy") * span_c).alias("c_custkey"),
        "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
    ).write.parquet(f"{out}/customer.parquet")
    orders.select("*", copies).select(
        (F.col("o_orderkey") + F.col("_copy") * span_o).alias("o_orderkey"),
        (F.col("o_custkey") + F.col("_copy") * span_c).alias("o_custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    ).write.parquet(f"{out}/orders.parquet")
    load(spark, sf_dir, "nation").write.parquet(f"{out}/nation.parquet")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    ks = [int(a) for a in argv[2:]] or [1, 4, 16]
    from freshet.plans import catalog
    from freshet.session import build_session, work_path

    spark = build_session(shuffle_partitions=8)
    # warm the JVM on the base data
    catalog.q_renewal_candidates(spark, sf_dir).write.format("noop").mode("overwrite").save()
    print("k  orders_rows  renewal_candidates_s  global_ordinal_s")
    for k in ks:
        out = work_path(spark, "scale", f"k{k}")
        replicate(spark, sf_dir, k, out)
        n = spark.read.parquet(f"{out}/orders.parquet").count()
        row = [k, n]
        for q in (catalog.q_renewal_candidates, catalog.q_global_ordinal):
            t0 = time.perf_counter()
            q(spark, out).write.format("noop").mode("overwrite").save()
            row.append(round(time.perf_counter() - t0, 2))
        print("  ".join(str(x) for x in row), flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
