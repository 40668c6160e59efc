"""Waves of commit batches: what is finished is not done again."""

import pytest
from pyspark.sql import functions as F

from freshet.operators.progress import finished_waves, run_in_waves
from freshet.session import work_path


class Killed(Exception):
    pass


def _plan(spark, n=23, rows=3):
    return lambda: spark.range(n * rows).select("id", F.floor(F.col("id") / rows).alias("commit_batch"))


def _work(factor):
    return lambda part: part.select("id", (F.col("id") * factor).alias("v"))


def test_a_dead_run_goes_on_after_its_last_finished_wave(spark):
    root, begun = work_path(spark, "waves"), []

    def dies(i):
        begun.append(i)
        if i == 3:
            raise Killed

    with pytest.raises(Killed):
        run_in_waves(spark, root, _plan(spark), _work(1), 5, before_wave=dies)
    assert begun == [0, 1, 2, 3] and finished_waves(spark, root, 5) == [0, 1, 2]
    # Half a wave, as a dead driver leaves it, and inputs that have changed since.
    _work(100)(_plan(spark)()).write.parquet(f"{root}/wave=3/_temporary/0/x")
    begun.clear()
    out = run_in_waves(spark, root, _plan(spark, n=500), _work(10), 5, before_wave=begun.append)
    assert begun == [3, 4]
    got = {r.id: r.v for r in out.collect()}
    # Waves hold 5 batches of 3 rows; the first three are as the first run left them.
    assert got == {i: i if i < 45 else 10 * i for i in range(69)}
    # A third run does nothing and gives the same.
    begun.clear()
    again = run_in_waves(spark, root, _plan(spark), _work(7), 5, before_wave=begun.append)
    assert not begun and {r.id: r.v for r in again.collect()} == got


def test_a_work_that_fails_leaves_its_wave_open(spark):
    root = work_path(spark, "waves_failing")
    bad = lambda part: part.select("id", F.when(F.col("id") == 50, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("v"))
    with pytest.raises(Exception, match="broken"):
        run_in_waves(spark, root, _plan(spark), bad, 5).count()
    assert finished_waves(spark, root, 5) == [0, 1, 2]
    assert run_in_waves(spark, root, _plan(spark), _work(1), 5).count() == 69


def test_few_batches_and_no_rows(spark):
    root = work_path(spark, "waves_few")
    assert run_in_waves(spark, root, _plan(spark, n=2), _work(1), 5).count() == 6
    root = work_path(spark, "waves_none")
    assert run_in_waves(spark, root, _plan(spark, n=0), _work(1), 5).count() == 0
