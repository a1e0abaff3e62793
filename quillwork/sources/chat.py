"""Chat records as lines of JSON: strict and tolerant reading, export and versioned sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.sources.store import delete_source

MESSAGES = "ARRAY<STRUCT<role: STRING, content: STRING>>"
ROLES = ("system", "user", "assistant")


def read_chat_lines(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """line, messages, error for each line that is not blank; strict reading ends at the first invalid line.

    error names the first thing wrong: malformed, no_messages, unknown_role, blank_content, missing_role, first_not_system.
    """
    lines = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", "line")
    m = F.from_json("line", f"messages {MESSAGES}").getField("messages")
    checked = lines.withColumn("messages", F.when(F.trim("line").like("{%}"), m)).withColumn("error", first_error(F.col("messages"), F.col("line")))
    if not strict:
        return checked
    # a filter is never pruned from a plan, as a column would be
    return checked.where(F.when(F.col("error").isNull(), True).otherwise(F.raise_error(F.concat(F.lit("invalid line: "), "error")).cast("boolean")))


def first_error(m, line):
    def holds(role: str):
        return F.exists(m, lambda x: x.role == role)

    missing = ~holds(ROLES[0]) | ~holds(ROLES[1]) | ~holds(ROLES[2])
    return (
        F.when(~F.trim(line).like("{%}"), "malformed")
        .when(m.isNull() | (F.size(m) == 0), "no_messages")
        .when(F.exists(m, lambda x: x.role.isNull() | ~x.role.isin(*ROLES)), "unknown_role")
        .when(F.exists(m, lambda x: x.content.isNull() | (F.trim(x.content) == "")), "blank_content")
        .when(missing, "missing_role")
        .when(F.get(m, F.lit(0)).role != "system", "first_not_system")
    )


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A file that is one JSON list of records."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def chat_lines(examples: DataFrame, prompt: str, answer: str, system_prompt: str) -> DataFrame:
    """value: one JSON line a row, with the fixed system prompt."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    record = F.struct(F.array(message("system", F.lit(system_prompt)), message("user", F.col(prompt)), message("assistant", F.col(answer))).alias("messages"))
    return examples.select(F.to_json(record).alias("value"))


def write_version(lines: DataFrame, folder: str, version: str, training_folder: str | None = None) -> str:
    """Write lines into a new versioned folder, and the same files into a training folder if one is given; an existing version is never overwritten."""
    path = f"{folder}/{version}"
    lines.write.mode("errorifexists").text(path)
    if training_folder:
        lines.sparkSession.read.text(path).write.mode("errorifexists").text(f"{training_folder}/{version}")
    return path


def replace_by_source(df: DataFrame, path: str, source: str = "source_document_id", emptied: list[int] = ()) -> None:
    """Replace the rows of the sources that df holds, remove those of `emptied`, and leave other sources as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).parquet(path)
    for one in emptied:
        delete_source(df.sparkSession, path, one, source)
