"""Session helpers: the only place that touches session-wide state."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared checkpoint folder the cluster names; make one only where none is set (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None)
    if not target:
        if not sc.master.startswith("local"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        target = tempfile.mkdtemp(prefix="benchloom-ckpt-")
    sc.setCheckpointDir(target)
    return target


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so that later jobs see one fixed copy of the rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Bound the bytes of the Arrow batches that Python gets; a number of rows alone says little about texts.

    A bound that the session has chosen, other than Spark's default of 64 MiB, stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "64MB", "64m"):
        spark.conf.set(key, str(size))


def fan_out(spark: SparkSession) -> int:
    """Partitions for grouped Python work.

    Such groups are small in bytes but heavy in time; a stated number keeps the adaptive planner from merging them
    into a few tasks.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
