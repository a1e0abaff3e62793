"""Queries that are written once and run by Spark or, as their check, by DuckDB."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillwork.plans.dialect import DUCK, Dialect, Spark
from quillwork.sources.tables import table

SqlOf = Callable[[Dialect], str]


def run_sql(spark: SparkSession, data_dir: str, sql_of: SqlOf) -> DataFrame:
    """Plan the query over the tables of a data directory; views are lazy and named by the directory."""
    d = Spark("_" + hashlib.md5(data_dir.encode()).hexdigest()[:8])
    text = sql_of(d)
    for name in d.used:
        table(spark, data_dir, name).createOrReplaceTempView(f"{name}{d.suffix}")
    return spark.sql(text)


def spark_query(sql_of: SqlOf) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, data_dir: run_sql(spark, data_dir, sql_of)


def queries_of(found: dict[str, SqlOf]) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: spark_query(f) for name, f in found.items()}


def oracle_of(found: dict[str, SqlOf]) -> dict[str, str]:
    return {name: f(DUCK) for name, f in found.items()}


#: Content columns of the tables with replayed rows.
COLUMNS = {
    "extracted_document_texts": "source_document_id raw_text page_count extraction_status",
    "document_chunks": "source_document_id chunk_index chapter section_title verse_number content content_type page_reference",
    "canonical_verses": "source_document_id chapter_number verse_number speaker sanskrit_text transliteration english_translation commentary page_reference is_valid",
    "wisdom_entries": "source_document_id book_title chapter section verse_number original_text transliteration translation commentary extracted_principle distilled_wisdom emotional_tags philosophical_tags use_cases confidence_score principle_quality_score principle_status",
}


def current(d: Dialect, name: str, where: str = "") -> str:
    """The rows of a table with replays taken out.

    A replay has the content of its row, so any of them stands for all: an aggregate with map-side combine, of which
    only the columns in use are read, and a filter may come before it, where it reaches the scan.
    """
    kept = ", ".join(f"any_value({c}) AS {c}" for c in COLUMNS[name].split())
    return f"(SELECT id, {kept} FROM {d.table(name)}{' WHERE ' + where if where else ''} GROUP BY id)"
