"""Work in waves of commit batches that a later run can go on with.

The plan (the rows to process, with their commit batch) is written once, so a run
that goes on works on what the first run saw, whatever has happened to the inputs
since. Consecutive batches make a wave, one Spark job whose result is written to a
folder of its own. The folder's success mark, which Spark's commit protocol writes
last, is the ledger: a wave with it is finished and never done again, anything else
in a folder is what a dead run left and is replaced. Repeating a wave therefore
changes nothing, and a run that dies loses one wave at most.

One run at a time per root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "_SUCCESS"


def _marked(spark: SparkSession, path: str) -> bool:
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARK}")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def finished_waves(spark: SparkSession, root: str, waves: int) -> list[int]:
    return [i for i in range(waves) if _marked(spark, f"{root}/wave={i}")]


def run_in_waves(
    spark: SparkSession,
    root: str,
    plan: Callable[[], DataFrame],
    work: Callable[[DataFrame], DataFrame],
    waves: int,
    batch_col: str = "commit_batch",
    before_wave: Callable[[int], None] | None = None,
) -> DataFrame:
    """The result of ``work`` on every row of ``plan()``, in at most ``waves``
    jobs over ranges of ``batch_col`` (0, 1, ...). Called again with the same
    ``root`` after a failure, it does what is missing. ``before_wave`` is told
    each wave's number before it starts. A wave's rows stay in its folder, so the
    result holds the column ``wave`` too.
    """
    root = root.rstrip("/")
    if not _marked(spark, f"{root}/plan"):
        plan().write.mode("overwrite").parquet(f"{root}/plan")
    rows = spark.read.parquet(f"{root}/plan")
    last = rows.agg(F.max(batch_col)).first()[0]
    size = -(-((last or 0) + 1) // waves)
    count = -(-((last or 0) + 1) // size)  # the same on every run: the plan is fixed
    done = set(finished_waves(spark, root, count))
    for i in range(count):
        if i not in done:
            if before_wave:
                before_wave(i)
            part = rows.where((F.col(batch_col) >= i * size) & (F.col(batch_col) < (i + 1) * size))
            work(part).write.mode("overwrite").parquet(f"{root}/wave={i}")
    paths = [f"{root}/wave={i}" for i in range(count)]
    return spark.read.option("basePath", root).parquet(*paths)
