"""Incremental jobs: files of rows arrive, each row is judged once.

The corpus statistics are made once, in a pre-pass, and written as a table of hot keys; every micro-batch computes the
facts of its own rows and joins them with that table (a stream-static join in foreachBatch), so the work of a batch
follows its rows. A batch writes the folder of its number and overwrites it when it is replayed, so a failure between
write and commit repeats nothing. The trigger ends when all files are read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.plans.audit_queries import A, HOT, audit, facts, hot_keys, keys_of
from quillwork.plans.lineage import cut, cut_table, ensure_checkpoint_dir
from quillwork.sources.tables import table


def example_stream(spark: SparkSession, data_dir: str, name: str = "training_examples") -> DataFrame:
    """A table as a stream of files; it may be one file or a folder of files."""
    schema = table(spark, data_dir, name).schema
    path = f"{data_dir}/{name}.parquet"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_folder = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
    return reader.parquet(path) if is_folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(data_dir)


def run_batches(stream: DataFrame, each, sink: str, state: str) -> None:
    """Write each(batch) of every micro-batch to its own folder of the sink until nothing is left to read."""

    def one(batch: DataFrame, number: int) -> None:
        each(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream.writeStream.foreachBatch(one).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def written(spark: SparkSession, sink: str, schema) -> DataFrame:
    """What the batches have written so far."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sink)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(sink)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def audit_stream(spark: SparkSession, data_dir: str, sink: str, state: str) -> None:
    """Run the incremental audit once over everything that has arrived: id, score, issues, status go to the sink."""
    hot = cut_table(hot_keys(keys_of(facts(table(spark, data_dir, "training_examples").select("id", A)), HOT), HOT))
    run_batches(example_stream(spark, data_dir).select("id", A), lambda batch: audit(cut(facts(batch)), hot), sink, state)


def stream_audit_available_now(spark: SparkSession, data_dir: str) -> DataFrame:
    """The audit through the stream; equal to the batch audit."""
    folder = new_folder(spark, "stream")
    audit_stream(spark, data_dir, f"{folder}/sink", f"{folder}/state")
    return spark.read.parquet(f"{folder}/sink").drop("batch")


def approvable(examples: DataFrame, entries: DataFrame, least: float = 85.0) -> DataFrame:
    """Ids that pass the approval gate: example and entry approved, a score of `least` or more, no issues. Stateless, so a replay gives the same rows."""
    gate = (F.col("dataset_status") == "approved") & (F.col("dataset_quality_score") >= least) & (F.size("dataset_audit_issues") == 0)
    approved = entries.where("principle_status = 'approved'").select(F.col("id").alias("wisdom_entry_id")).distinct()
    return examples.where(gate).join(approved, "wisdom_entry_id", "left_semi").select("id")


def stream_approval_available_now(spark: SparkSession, data_dir: str) -> DataFrame:
    """The approval log of the stream of examples."""
    folder, entries = new_folder(spark, "approval"), table(spark, data_dir, "wisdom_entries")
    rows = example_stream(spark, data_dir).select("id", "wisdom_entry_id", "dataset_status", "dataset_quality_score", "dataset_audit_issues")
    run_batches(rows, lambda batch: approvable(batch, entries), f"{folder}/sink", f"{folder}/state")
    return spark.read.parquet(f"{folder}/sink").drop("batch")


QUERIES = {f.__name__: f for f in (stream_audit_available_now, stream_approval_available_now)}
