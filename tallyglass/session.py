"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # from_unixtime and unix_timestamp follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# What one task of a large shuffle should read.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
UNKNOWN_BYTES = 1 << 60

_local_root: str | None = None


def prepare(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the run-time settings the operators rely on to an open session.

    With the size of the largest input, shuffles start with as many partitions as
    that needs. Adaptive execution merges those that turn out small but cannot
    split those of an aggregate, so the number has to be large enough from the start.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        partitions = shuffle_partitions(spark, input_bytes)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    return spark


def shuffle_partitions(spark: SparkSession, input_bytes: int) -> int:
    """Never fewer than the session's own setting."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(own, math.ceil(input_bytes / SHUFFLE_PARTITION_BYTES))


def input_bytes(df: DataFrame) -> int:
    """Size of all that ``df`` reads, from file listings; runs no job. What Spark
    knows no size of counts nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


def is_plain_scan(df: DataFrame) -> bool:
    """``df`` is files less some rows and columns, so that reading it again costs a
    pruned scan and no join, grouping or generated row."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def own_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A prepared session for one run: same cluster and settings, but what the run
    sets neither stays behind nor meets another run."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    return prepare(session, input_bytes)


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Executors of a cluster must all see it, so a machine-local folder is used
    only by a local session that names none.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="tallyglass-")
        root = _local_root
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
