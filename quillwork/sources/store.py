"""Tables that jobs write: snapshots with renewed columns, and deletion of one source."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_back(table: DataFrame, renewed: DataFrame, key: str, folder: str, version: str) -> str:
    """A new snapshot of a table in which the columns of `renewed` replace those of the rows with its keys; other rows stay.

    A snapshot is never changed: the path of the new one is given back, and writing an existing version fails.
    """
    new = [c for c in renewed.columns if c != key]
    fresh = renewed.select(key, *[F.col(c).alias(f"_new_{c}") for c in new], F.lit(True).alias("_hit"))
    joined = table.join(fresh, key, "left")
    merged = joined.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in table.columns])
    path = f"{folder}/{version}"
    merged.write.mode("errorifexists").parquet(path)
    return path


def format_size(n: int) -> str:
    """A number of bytes in the largest unit of which there is one, with one decimal."""
    size = float(n)
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if size < 1024 or unit == "TB":
            return f"{size:.1f} {unit}"
        size /= 1024
    return ""


def delete_source(spark: SparkSession, path: str, source: int, column: str = "source_document_id") -> tuple[bool, str, str]:
    """Remove one source from a table that is partitioned by it: (whether it was there, size before, size after). Only its folder is touched."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    before = fs.getContentSummary(root).getLength()
    gone = fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{column}={source}"), True)
    return gone, format_size(before), format_size(fs.getContentSummary(root).getLength())


def upload_name(original: str) -> str:
    """A name for an uploaded file that no other upload has: its stem in lower case, a random part, its suffix."""
    name = original.replace("\\", "/").rpartition("/")[2].strip()
    stem, dot, suffix = name.rpartition(".")
    if not dot or not stem:
        stem, suffix = name.lstrip("."), "pdf"
    return f"{stem.strip().replace(' ', '_').lower() or 'document'}_{uuid.uuid4().hex}.{suffix.lower() or 'pdf'}"


def markdown_report(title: str, rows: list, columns: list[str]) -> str:
    """A report of few rows as a heading and a table; numbers to the right."""
    cells = [[("" if r[c] is None else str(r[c])).replace("|", "\\|") for c in columns] for r in rows]
    right = [all(isinstance(r[c], (int, float)) or r[c] is None for r in rows) and bool(rows) for c in columns]
    lines = [f"# {title}", "", "| " + " | ".join(columns) + " |", "| " + " | ".join("---:" if x else "---" for x in right) + " |"]
    return "\n".join(lines + ["| " + " | ".join(row) + " |" for row in cells]) + "\n"
