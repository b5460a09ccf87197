"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join inputs even where the next operator then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Dimensions up to this size are broadcast; the plans check every size against it.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
}

SHUFFLE_PARTITION_BYTES = 128 << 20
_LOCAL_WORK_DIR = "tillspark.local.work.dir"
#: Spark's setting that removes the shuffle files of a query when it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "tillspark", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the plans are written for; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Raise ``spark.sql.shuffle.partitions`` to what an input of this size needs; never lower it.

    The adaptive planner merges partitions that turn out small, but cannot make
    more of them than were planned.
    """
    wanted = math.ceil(input_bytes / SHUFFLE_PARTITION_BYTES)
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < wanted:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Around a write: its shuffle files have no reader after it and go with it.

    Spark alone keeps them until the driver happens to collect its garbage.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, one per application.

    A cluster names the shared folder in ``spark.checkpoint.dir``.  Only where
    that is unset and the master is local (a test) a temporary folder is made,
    once per session; elsewhere executors would not find each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL_WORK_DIR, None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tillspark-")
        spark.conf.set(_LOCAL_WORK_DIR, root)
    return f"{root.rstrip('/')}/tillspark-{spark.sparkContext.applicationId}"
