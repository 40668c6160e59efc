"""Shared pieces: folds, and columns that pass unchanged."""

import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from freshet.llm.common import fold, map_texts


def test_fold(spark):
    df = spark.createDataFrame([(0,), (7,), (-7,), (2**60 + 1,), (None,)], "k long").select("k", fold(F.col("k"), 4).alias("f"))
    assert {r.k: r.f for r in df.collect()} == {k: zlib.crc32(str(k).encode()) % 4 if k is not None else 0 for k in (0, 7, -7, 2**60 + 1, None)}


def test_other_columns_pass_unchanged(spark):
    rows = [(2**62 + 1, "ab", [1, None], 1.5, None), (None, None, None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, a array<int>, d double, `odd name` string")
    out = map_texts(df, lambda: lambda texts: ([len(t or "") for t in texts],), {"n": ("long", pa.int64())}, drop=("d",))
    assert out.columns == ["doc_id", "text", "a", "odd name", "n"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(2**62 + 1, "ab", [1, None], None, 2), (None, None, None, "x", 0)], key=str)
