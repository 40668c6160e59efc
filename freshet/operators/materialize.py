"""Cut lineage by writing an intermediate result to the shared folder.

Used where a derived result is read by more than one pass (the two-pass
ordinal reads its input for the bucket totals and again for the numbers):
without it each pass would recompute the joins and aggregates upstream.
The table lives below ``spark.checkpoint.dir``, so a lost executor costs a
re-read, not a recomputation, and no machine-local folder is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from freshet.session import work_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, "stage", name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The written table and its rows, counted while they are written. The count
    stands directly under the write, in the job's last stage: there a partition
    counts once however often it is tried, while a stage before a shuffle that is
    repeated for a lost executor would count twice."""
    seen = Observation()
    out = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]
