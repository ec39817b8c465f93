"""Session settings and the shared scratch location every job agrees on."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings a cluster submit script would pass; cluster-sized values (executor
# memory, shuffle partitions) stay with the operator of the cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Binary payloads may be tens of megabytes each: bound Arrow batches by size.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
}


def build_session(app_name: str = "topicsieve", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    temporary folder serves a ``local`` master, whose tasks share the driver's
    disk; any other master is refused, as its executors would not see the files.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="topicsieve-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return os.path.join(checkpoint_root(spark), f"{label}-{uuid.uuid4().hex}")


def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage at ``df`` with a reliable checkpoint.

    Used where later stages must see exactly the same partition numbers twice.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="topicsieve-"), root.name)
    context.addPyFile(shutil.make_archive(archive, "zip", root.parent, root.name))
    _shipped.add(context.applicationId)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores enough tasks to use them all.

    A large table already has many more splits than cores, so this does nothing
    there; it only pays a shuffle for small inputs stored in a few row groups.
    For scans and projections of scans: asking a plan with a shuffle in it for
    its partitions would run that shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """Deal rows to tasks of about ``rows`` rows each, for work that takes long by the row.

    For scans and projections of scans, whose rows are counted without reading them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows)))


# Tasks of a scan that are joined: Spark packs 32 small files into one, as it counts 4 MB for opening each.
SCANS_A_TASK = 64
# Bytes that a task of joined scans reads, about.
TASK_BYTES = 128 << 20


def gathered(files: DataFrame) -> DataFrame:
    """Read many small files (with their ``length``) in fewer tasks; large files stay as they are dealt.

    For scans of files, whose tasks are joined without a shuffle. Their lengths are added
    up without reading them.
    """
    cores = files.sparkSession.sparkContext.defaultParallelism
    size = files.agg(F.sum("length").alias("n")).first()["n"] or 0
    now = files.rdd.getNumPartitions()
    wanted = max(cores, -(-size // TASK_BYTES), -(-now // SCANS_A_TASK))
    return files.coalesce(wanted) if wanted < now else files
