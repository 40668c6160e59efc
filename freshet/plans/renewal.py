"""The renewal job: select the tariffs due for approval and apply the updates.

Inputs are four tables (``tariff``, ``tariff_domain``, ``tariff_data`` and
per-stage outcome tables); outputs are new snapshots of the changed tables
plus message and audit rows. The procedural loop of the original becomes:

* candidate selection: one row per active tariff of a non-personal domain
  with its newest active version, filtered by the readiness flags;
* ``rnum``: the row's ordinal in the joined relation *before* keeping only
  the newest version, i.e. a running sum of versions per tariff;
* each branch of the loop body becomes a keyed join producing a snapshot.

Scale notes: the versions table is reduced to one row per tariff with a
partial aggregate (``max_by`` + ``count``) before any join, so a tariff
holding a third of all versions costs no more than any other. The ordinal
is the two-pass running sum over key ranges from ``operators.ordinal``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.text import first_char, oracle_concat
from freshet.operators.hierarchy import resolve_paths
from freshet.operators.materialize import materialize
from freshet.operators.ordinal import running_total
from freshet.operators.scan import LAST, running_fold

# Fixed values used by the job (flag letters and message texts).
ACTIVE = "A"
YES = "Y"
NO = "N"
PERSONAL_DOMAIN = "N"
TEMPLATE_DOMAIN = "T"
ERROR_CODE = "E"
INFO_CODE = "I"
COMMIT_INTERVAL = 5
STAGE_TARIFFS = "TARIFFS"
STAGE_TEMPLATES = "TEMPLATE TARIFF DOMAINS"
JOB_NAME = "renewal"
STARTED = "Action STARTED: Approve "
FINISHED = "Action FINISHED: Approve "
FAILED_PREFIX = "Approve failed for "

CANDIDATE_COLUMNS = [
    "t_id", "tariff_domain__oid", "t_name", "t_is_ready",
    "tv_id", "tv_is_ready", "tv_date_from",
]


def latest_versions(tariff_data: DataFrame) -> DataFrame:
    """Newest active version per tariff and the number of active versions.

    Equivalent to ``row_number() over (partition by tariff order by id desc)
    = 1`` but computed as a partial aggregate, so it combines map-side.
    """
    active = tariff_data.filter(F.col("amnd_state") == ACTIVE)
    newest = F.max_by(
        F.struct(
            F.col("id").alias("tv_id"),
            F.col("is_ready").alias("tv_is_ready"),
            F.col("date_from").alias("tv_date_from"),
        ),
        F.col("id"),
    )
    return active.groupBy("tariff__oid").agg(
        newest.alias("tv"), F.count(F.lit(1)).alias("n_versions")
    )


def renewal_scope(tariff: DataFrame, tariff_domain: DataFrame, tariff_data: DataFrame) -> DataFrame:
    """Active tariffs of personal='N' domains, each with its newest active version.

    ``n_rows`` is how many rows the tariff contributes to the joined relation
    (its active versions, or 1 when it has none): the weight of ``rnum``.
    """
    t = tariff.filter(F.col("amnd_state") == ACTIVE).select(
        F.col("id").alias("t_id"),
        "tariff_domain__oid",
        F.col("name").alias("t_name"),
        F.col("is_ready").alias("t_is_ready"),
    )
    td = tariff_domain.filter(F.col("is_personal") == PERSONAL_DOMAIN).select(
        F.col("id").alias("_td_id")
    )
    scoped = t.join(td, t["tariff_domain__oid"] == td["_td_id"], "inner").drop("_td_id")
    # The residual amnd_state predicate of the LEFT JOIN is applied to the
    # right side before joining, which keeps tariffs without a version.
    v = latest_versions(tariff_data)
    joined = scoped.join(v, scoped["t_id"] == v["tariff__oid"], "left")
    return joined.select(
        "t_id", "tariff_domain__oid", "t_name", "t_is_ready",
        F.col("tv.tv_id").alias("tv_id"),
        F.col("tv.tv_is_ready").alias("tv_is_ready"),
        F.col("tv.tv_date_from").alias("tv_date_from"),
        F.coalesce(F.col("n_versions"), F.lit(1).cast("long")).alias("n_rows"),
    )


def needs_renewal() -> Column:
    """Three-valued: a NULL flag makes its side UNKNOWN, never TRUE."""
    return (F.col("t_is_ready") != YES) | (F.col("tv_is_ready") != YES)


def renewal_candidates(
    tariff: DataFrame,
    tariff_domain: DataFrame,
    tariff_data: DataFrame,
    with_rnum: bool = True,
    n_buckets: int | None = None,
) -> DataFrame:
    cols = list(CANDIDATE_COLUMNS)
    if with_rnum:
        # The ordinal reads its input twice (range bounds, ranges); write the
        # one-row-per-tariff scope once instead of re-aggregating tariff_data.
        scope = materialize(renewal_scope(tariff, tariff_domain, tariff_data), "renewal_scope")
        scope = running_total(scope, ["t_id"], value=F.col("n_rows"), out="rnum", n_buckets=n_buckets)
        cols.append("rnum")
    else:
        scope = renewal_scope(tariff, tariff_domain, tariff_data)
    return scope.filter(needs_renewal()).select(*cols)


def commit_batches(df: DataFrame, order_col: str = "rnum", interval: int = COMMIT_INTERVAL,
                   n_buckets: int | None = None) -> DataFrame:
    """Batch id of each processed row: COMMITs issued before it.

    A COMMIT follows every processed row whose ordinal is a multiple of
    ``interval``; the batch of a row is the count of such rows before it
    (not ``(row_number - 1) div interval``: ordinals skipped by the
    candidate cut make some batches longer than ``interval``).
    """
    point = F.when(F.col(order_col) % interval == 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return running_total(df, [order_col], value=point, out="commit_batch",
                         inclusive=False, n_buckets=n_buckets)


def _replaced(df: DataFrame, column: str, value: Column) -> list[Column]:
    """All columns of ``df`` in place; ``column`` (any case) gets ``value`` under
    the name and type it has."""
    return [
        value.cast(f.dataType).alias(f.name) if f.name.lower() == column else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]


def mark_ready(tariff: DataFrame, candidates: DataFrame) -> DataFrame:
    """New tariff snapshot: is_ready = 'Y' for candidates without a version.
    Every other column stays as it is."""
    hits = candidates.filter(F.col("tv_id").isNull()).select(
        F.col("t_id").alias("_hit_id"), F.lit(True).alias("_hit")
    )
    j = tariff.join(hits, tariff["id"] == hits["_hit_id"], "left")
    return j.select(*_replaced(tariff, "is_ready", F.when(F.col("_hit"), F.lit(YES)).otherwise(F.col("is_ready"))))


def versions_to_clear(candidates: DataFrame) -> DataFrame:
    """Ids of unready dated newest versions."""
    return candidates.filter((F.col("tv_is_ready") == NO) & F.col("tv_date_from").isNotNull()).select(F.col("tv_id").alias("id"))


def clear_date_from(tariff_data: DataFrame, candidates: DataFrame) -> DataFrame:
    """New tariff_data snapshot: date_from = NULL on unready dated newest
    versions. Every other column stays as it is."""
    hits = versions_to_clear(candidates).select(F.col("id").alias("_hit_id"), F.lit(True).alias("_hit"))
    j = tariff_data.join(hits, tariff_data["id"] == hits["_hit_id"], "left")
    return j.select(*_replaced(tariff_data, "date_from", F.when(F.col("_hit"), F.lit(None)).otherwise(F.col("date_from"))))


def set_constants(constants: DataFrame, ldate: Column) -> DataFrame:
    """Whole-table update without WHERE: date_from = ldate + 1, date_to = NULL."""
    new = {"date_from": F.date_add(ldate, 1), "date_to": F.lit(None).cast("date")}
    return constants.select(*[new[c.lower()].alias(c) if c.lower() in new else F.col(f"`{c}`") for c in constants.columns])


def template_domains(tariff: DataFrame, tariff_domain: DataFrame) -> DataFrame:
    """Active template domains holding at least one active unready tariff.

    The correlated EXISTS is a left semi join; the tariff side is first
    reduced to its distinct domain ids (partial aggregate, tiny shuffle).
    """
    unready = (
        tariff.filter((F.col("amnd_state") == ACTIVE) & (F.col("is_ready") == NO))
        .select(F.col("tariff_domain__oid").alias("_dom"))
        .distinct()
    )
    td = tariff_domain.filter(
        (F.col("amnd_state") == ACTIVE) & (F.col("is_personal") == TEMPLATE_DOMAIN)
    )
    return td.join(unready, td["id"] == unready["_dom"], "left_semi")


def is_error(err_msg: Column, code: str = ERROR_CODE) -> Column:
    """Error test on an outcome text: its first character is the error code."""
    return F.coalesce(first_char(err_msg) == code, F.lit(False))


def domain_paths(tariff_domain: DataFrame) -> DataFrame:
    """(id, path, depth, state) of every domain (id, parent_id, code): its codes
    from the top of its tree."""
    return resolve_paths(tariff_domain.select("id", "parent_id", "code"))


def applied_results(candidates: DataFrame, apply_result: DataFrame, carry: bool = False) -> DataFrame:
    """The candidates that have an error text to look at, with it (``err_msg``).

    Only candidates with a version are applied. The original never resets the
    text, so a candidate without a version is judged by the text of the last one
    applied before it (which may be NULL: the last apply went well). ``carry``
    does the same, by a running fold over ``rnum``; the text goes in a struct, so
    that a NULL text counts as one.
    """
    res = apply_result.select(F.col("id").alias("_res_id"), "err_msg")
    if not carry:
        applied = candidates.filter(F.col("tv_id").isNotNull())
        return applied.join(res, applied["t_id"] == res["_res_id"], "left").drop("_res_id")
    j = candidates.join(res, (candidates["t_id"] == res["_res_id"]) & candidates["tv_id"].isNotNull(), "left").drop("_res_id")
    own = F.when(F.col("tv_id").isNotNull(), F.struct("err_msg"))
    last = running_fold(materialize(j, "applied"), ["rnum"], own, LAST, "_last")
    return last.withColumn("err_msg", F.col("_last.err_msg")).drop("_last")


def tariff_messages(candidates: DataFrame, tariff_domain: DataFrame, apply_result: DataFrame, carry: bool = False) -> DataFrame:
    """Messages of the tariff stage: one per versioned candidate whose apply failed.

    Candidates without a version are never applied, so they get no message; with
    ``carry`` they repeat the last error, as the original does. A domain's code is
    taken from ``tariff_domain`` (id, code); give ``domain_paths`` as codes to name
    domains by their place in the tree.
    """
    dom = tariff_domain.select(F.col("id").alias("_dom_id"), F.col("code").alias("_code"))
    j = applied_results(candidates, apply_result, carry).join(dom, F.col("tariff_domain__oid") == F.col("_dom_id"), "left")
    text = oracle_concat(
        F.lit(FAILED_PREFIX + '"'), F.col("_code"), F.lit("/"), F.col("t_name"),
        F.lit('": '), F.col("err_msg"),
    )
    out = [
        F.lit(STAGE_TARIFFS).alias("stage"),
        F.col("t_id").alias("id"),
        first_char(F.col("err_msg")).alias("severity"),
        text.alias("message"),
    ]
    if "rnum" in candidates.columns:
        out.append(F.col("rnum").alias("seq"))
    return j.filter(is_error(F.col("err_msg"))).select(*out)


def processed(batches: DataFrame, tariff_domain: DataFrame, apply_result: DataFrame) -> DataFrame:
    """What the loop does with each candidate of ``batches`` (candidates with
    their commit batch): the action, and the message of a failed apply."""
    action = F.when(F.col("tv_id").isNull(), "mark_ready").when(
        (F.col("tv_is_ready") == NO) & F.col("tv_date_from").isNotNull(), "clear_and_apply").otherwise("apply")
    said = tariff_messages(batches, tariff_domain, apply_result).select(F.col("id").alias("_said"), "severity", "message")
    rows = batches.select("t_id", "rnum", "commit_batch", action.alias("action"))
    return rows.join(said, rows["t_id"] == said["_said"], "left").drop("_said")


def domain_messages(domains: DataFrame, approve_result: DataFrame) -> DataFrame:
    """Messages of the template-domain stage."""
    res = approve_result.select(F.col("id").alias("_res_id"), "err_msg")
    j = domains.join(res, domains["id"] == res["_res_id"], "left")
    return j.filter(is_error(F.col("err_msg"))).select(
        F.lit(STAGE_TEMPLATES).alias("stage"),
        F.col("id"),
        first_char(F.col("err_msg")).alias("severity"),
        oracle_concat(F.lit(FAILED_PREFIX), F.col("code")).alias("message"),
        F.col("id").alias("seq"),
    )


def stage_markers(stage_no: int, stage: str, processed: DataFrame, n: int | None = None) -> DataFrame:
    """STARTED and FINISHED rows of one stage; FINISHED carries the row count,
    ``n`` if it is known from when the rows were written."""
    counted = (processed.agg(F.count(F.lit(1)).alias("n")) if n is None
               else processed.sparkSession.range(1).select(F.lit(n).cast("long").alias("n")))
    marks = F.array(
        F.struct(F.lit(0).alias("phase"), F.lit(JOB_NAME + ": " + STARTED + stage).alias("message"),
                 F.lit(None).cast("long").alias("n_processed")),
        F.struct(F.lit(2).alias("phase"), F.lit(JOB_NAME + ": " + FINISHED + stage).alias("message"),
                 F.col("n").alias("n_processed")),
    )
    return counted.select(F.explode(marks).alias("m")).select(
        F.lit(stage_no).alias("stage_no"),
        F.lit(stage).alias("stage"),
        F.col("m.phase").alias("phase"),
        F.lit(0).cast("long").alias("seq"),
        F.lit(INFO_CODE).alias("severity"),
        F.col("m.message").alias("message"),
        F.col("m.n_processed").alias("n_processed"),
    )


def audit_log(
    candidates: DataFrame, domains: DataFrame, tariff_msgs: DataFrame, domain_msgs: DataFrame,
    n_candidates: int | None = None, n_domains: int | None = None,
) -> DataFrame:
    """Ordered union of stage markers and messages (sequence: stage_no, phase, seq)."""

    def body(stage_no: int, msgs: DataFrame) -> DataFrame:
        return msgs.select(
            F.lit(stage_no).alias("stage_no"), "stage", F.lit(1).alias("phase"),
            F.col("seq").cast("long").alias("seq"), "severity", "message",
            F.lit(None).cast("long").alias("n_processed"),
        )

    return (
        stage_markers(1, STAGE_TARIFFS, candidates, n_candidates)
        .unionByName(body(1, tariff_msgs))
        .unionByName(stage_markers(2, STAGE_TEMPLATES, domains, n_domains))
        .unionByName(body(2, domain_msgs))
    )
