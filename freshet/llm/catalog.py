"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freshet.llm import (
    op1_language_id, op2_secrets, op3_url_filters, op4_quality, op5_chat, op6_html, op7_simhash, op8_decontamination, op9_mixing, op10_ann,
    op11_repair, op12_pii, op13_manifest,
)

MODULES = (
    op1_language_id, op2_secrets, op3_url_filters, op4_quality, op5_chat, op6_html, op7_simhash, op8_decontamination, op9_mixing, op10_ann,
    op11_repair, op12_pii, op13_manifest,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
