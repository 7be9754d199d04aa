"""Session helpers: the shared folder, durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "scorefold", initial_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library is written for.

    initial_partitions is the number of shuffle partitions to start from; AQE
    merges small ones, so set it for the largest shuffle (its size / 200 MB).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # no call-site capture per column operation: wide tables need hundreds of them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if initial_partitions is not None:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="scorefold-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never reused, so a rerun cannot read stale files."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder, as Parquet, and read it from there on.

    For inputs that several jobs read again (model fits, sweeps): the lineage is
    cut, a lost executor costs a re-read instead of a recompute, and each job
    reads the columns it needs.  The folder belongs to the job: delete it with
    the job's other files in the shared folder.
    """
    path = scratch_path(df.sparkSession, "durable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
