"""Whole jobs: read the inputs, write new snapshots, publish them together.

``run_renewal`` is the batch job of the renewal plan. All new versions are
written first, every gate is checked on what was written, and only then
one manifest names them all, so a rejected or broken run leaves every table
at its previous version. (The original committed every few rows, which made
its rollback partial; the commit batch of each processed row is still
recorded in the candidates output.)

Tables that are updated in place keep every column, name and type; the
declared columns are taken only where candidates and messages are derived.

``run_status_refresh`` is the batch form of the streaming status refresh.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.materialize import materialize, materialize_counted
from freshet.operators.snapshot import current_version, publish, publish_all, same_table, write_version
from freshet.plans import renewal, weather
from freshet.sources import schemas


@dataclass
class RunResult:
    published: bool
    versions: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)


def run_renewal(
    spark: SparkSession,
    out_root: str,
    tariff: DataFrame,
    tariff_domain: DataFrame,
    tariff_data: DataFrame,
    constants: DataFrame,
    apply_result: DataFrame,
    approve_result: DataFrame,
    ldate: Column,
    commit_interval: int = renewal.COMMIT_INTERVAL,
    reject: bool = False,
) -> RunResult:
    out_root = out_root.rstrip("/")
    t = schemas.conform(tariff, schemas.TARIFF)
    td = schemas.conform(tariff_domain, schemas.TARIFF_DOMAIN)
    tv = schemas.conform(tariff_data, schemas.TARIFF_DATA)
    schemas.conform(constants, schemas.LOCAL_CONSTANTS)  # fails on missing columns
    # One row per candidate tariff; read by every step below, so written once.
    cands, n_cands = materialize_counted(renewal.renewal_candidates(t, td, tv), "candidates")
    domains, n_domains = materialize_counted(renewal.template_domains(t, td), "domains")
    tmsg = renewal.tariff_messages(cands, td, schemas.conform(apply_result, schemas.OUTCOME))
    dmsg = renewal.domain_messages(domains, schemas.conform(approve_result, schemas.OUTCOME))

    outputs = {
        "v_local_constants": renewal.set_constants(constants, ldate),
        "candidates": renewal.commit_batches(cands, interval=commit_interval),
        "tariff": renewal.mark_ready(tariff, cands),
        "tariff_data": renewal.clear_date_from(tariff_data, cands),
        "audit": renewal.audit_log(cands, domains, tmsg, dmsg, n_cands, n_domains),
    }
    # Tables updated in place must keep every row, column and type.
    in_place = {"tariff": tariff, "tariff_data": tariff_data, "v_local_constants": constants}

    result = RunResult(published=False)
    base = {name: current_version(spark, f"{out_root}/{name}") for name in outputs}
    for name, df in outputs.items():
        path = write_version(df, f"{out_root}/{name}")
        result.versions[name] = path
        result.counts[name] = spark.read.parquet(path).count()

    if not reject and all(same_table(spark.read.parquet(result.versions[n]), df) for n, df in in_place.items()):
        publish_all(spark, out_root, result.versions, base)
        result.published = True
    return result


def refresh_and_publish(
    spark: SparkSession,
    status_root: str,
    parsed: DataFrame,
    locations: DataFrame,
    log_path: str,
    audit_path: str,
    extra_audit: DataFrame | None = None,
) -> RunResult:
    """One refresh from staged bodies. The log and the audit go to folders of
    their own that a repeated run overwrites; the gate compares the new status
    with the old one before it is published."""
    was = current_version(spark, status_root)
    if was is None:
        raise ValueError(f"no published status table under {status_root}")
    status = spark.read.parquet(was)
    new_status, parsed, errors = weather.refresh_parsed(status, parsed, locations)
    path = write_version(new_status, status_root)
    written = spark.read.parquet(path)
    result = RunResult(published=False, versions={"status": path}, counts={"status": written.count()})
    if same_table(written, weather.with_arrival(status)):  # no insert, no loss
        if extra_audit is not None:
            errors = errors.unionByName(extra_audit)
        weather.append_log(parsed, log_path, mode="overwrite")
        errors.write.mode("overwrite").parquet(audit_path)
        publish(spark, status_root, path, base=was, check_base=True)
        result.published = True
    return result


def run_status_refresh(
    spark: SparkSession,
    status_root: str,
    responses: DataFrame,
    locations: DataFrame,
    log_path: str,
    audit_path: str,
    run_id: str | None = None,
) -> RunResult:
    """One refresh of the status table from a batch of landed responses.

    ``run_id`` names the run's part of the log and the audit; a run repeated
    under the same id replaces its part instead of adding it twice.
    """
    run_id = run_id or uuid.uuid4().hex
    parsed = materialize(weather.parsed_bodies(responses), "bodies")
    return refresh_and_publish(
        spark, status_root, parsed, locations, f"{log_path}/run_id={run_id}", f"{audit_path}/run_id={run_id}")
