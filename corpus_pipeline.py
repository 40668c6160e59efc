"""The corpus pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All stages but the last
return the columns of documents; the last returns the mix of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.llm.op1_language_id import keep_identified
from freshet.llm.op2_secrets import mask_secrets
from freshet.llm.op7_simhash import keep_one_of_each_group
from freshet.llm.op8_decontamination import drop_contaminated
from freshet.llm.op9_mixing import mix_sources
from freshet.operators.materialize import materialize
from freshet.sources.tables import load

STAGES = [
    ("language_id", keep_identified),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Learned prototypes, connected components and latent vectors have no SQL form.
# tests/llm/test_pipeline.py checks every stage against a brute-force version.
ORACLE_SQL = None
