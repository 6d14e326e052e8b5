"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that matter on a cluster. Shuffle partitions stay a starting point that AQE coalesces;
# the advisory size keeps a reduce task near 128 MB whatever the input size.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Call-site capture costs several JVM calls per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "creditloom", **conf: str) -> SparkSession:
    """A session with the defaults above; keyword keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="creditloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    spark = df.sparkSession
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint()


def collect_garbage(spark: SparkSession) -> None:
    """For loops of many jobs: plans, broadcasts and shuffle files of jobs that are over go when the driver's JVM collects what nothing
    refers to any more, and by itself it first grows to its limit."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


SMALL_ROWS = 20_000


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """The same rows as a local table when there are at most `max_rows`, else `df` unchanged.

    For the side of a join that is small by nature (one row per category or bucket). The size is
    proven here, so it is broadcast and the other side does not move; a side that turns out larger
    stays a distributed table and is joined by shuffle.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
