"""Reliable lineage cuts in the folder that all executors share."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use spark.checkpoint.dir of the session; only where it is unset and all runs on this machine (tests), a folder of our own."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="quillwork-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """checkpoint(): the rows are written once to the shared folder and survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_table(df: DataFrame) -> DataFrame:
    """As cut(), by a compressed table in the same folder: smaller than a checkpoint where rows are wide. It is removed when the program ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session is over; its folder goes with it
        pass


def sweep(spark: SparkSession) -> None:
    """Let go of shuffle files that nothing refers to any more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def partitions(spark: SparkSession, least: int) -> Iterator[None]:
    """At least so many shuffle partitions for what runs inside."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), least)))
    try:
        yield
    finally:
        spark.conf.set(name, before)
