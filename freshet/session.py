"""Session construction and the shared work folder.

Jobs never write to a machine-local temporary folder: anything they
materialize (snapshots, landed files, streaming checkpoints, lineage cuts)
goes below the folder the cluster names in ``spark.checkpoint.dir``. Only
when that setting is missing (local tests) do we choose one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    master: str | None = None,
    app_name: str = "freshet",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE on, UTC time and the UI off.

    ``shuffle_partitions`` should be sized to the data: roughly input bytes
    of the widest shuffle divided by ~128 MB. AQE coalesces what is too
    small at runtime, so erring high is cheaper than erring low.
    """
    builder = SparkSession.builder.appName(app_name)
    # Only an explicit master is set; under spark-submit the cluster's applies.
    master = master or os.environ.get("FRESHET_MASTER")
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Streaming state of millions of keys does not fit the JVM heap.
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def require_local(master: str) -> None:
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(
            f"spark.checkpoint.dir is not set; with the master {master} it must name a folder all machines share"
        )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    ``spark.checkpoint.dir`` is a core setting that cannot change at runtime,
    so a missing folder is set on the SparkContext and read back from it.
    Only a local master may do without it: on a cluster a folder of our own
    choice would be another one on every machine.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        require_local(sc.master)
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="freshet-ckpt-"))
        base = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared folder, by default a fresh one per call."""
    base = ensure_checkpoint_dir(spark)
    segs = [base, "freshet", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join(s.strip("/") if i else s.rstrip("/") for i, s in enumerate(segs))
