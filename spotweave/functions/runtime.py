"""Session helpers: durable intermediate tables below the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Tables written inside an open ``durable_scope``.
_SCOPES: list[list[str]] = []


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that spark.checkpoint.dir names; without one durable steps can't run."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("CHECKPOINT_DIR_UNSET: set spark.checkpoint.dir to a shared folder")
    sc.setCheckpointDir(shared)


def own_checkpoint_dir(spark: SparkSession) -> None:
    """For entry points, tests and the bench: a local run that names no shared folder gets one of its own."""
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not sc.getCheckpointDir() and sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def durable_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the durable tables made inside when it ends; the result must be written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def durable(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives executor loss.

    A written table also leaves the old plan's inferred constraints behind, which
    grow with every round of an iterative job, and tells the planner its real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered_partitions(df: DataFrame, out: str) -> DataFrame:
    """The rows with their partition's number, written with them so that every reading sees the same one."""
    return durable(df.withColumn(out, F.spark_partition_id()))


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed code or contrast dimension of a few rows."""
    return spark.createDataFrame(rows, schema)
