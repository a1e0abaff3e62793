"""Queries that SQL cannot state: similarity by alignment, greedy selection, streaming."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.functions import text as X
from quillwork.functions import vocab as V
from quillwork.operators import greedy
from quillwork.operators.similarity import similar_pairs as pairs_of
from quillwork.plans.base import run_sql
from quillwork.plans.document_queries import rewrite_pool as pool_sql
from quillwork.plans.lesson_queries import scenario_families
from quillwork.plans.lineage import cut, cut_table
from quillwork.plans.scalar_queries import entry_text
from quillwork.sources.tables import first_arrival, table
from quillwork.streaming.audit import example_stream, new_folder, run_batches, written

OPENINGS = ["Start small.", "Look once more.", "Stay with it.", "Wait a breath.", "Ask plainly.", "Put it down."]
MIDDLES = ["Name what you fear.", "Write one line about it.", "Do the next small task.", "Leave one thing unsaid.", "Walk to the end of the road.", "Let the other speak first.", "Keep one promise today."]
ENDS = V.CLOSERS + ["Come back to it tomorrow.", "Let that be enough."]
PROMPTS = ["How do I meet {x}?", "What helps with {x}?", "Where does {x} end?", "Who can teach me about {x}?", "When is {x} enough?"]
EXAMPLE = "source long, ordinal long, variant int, prompt string, opening string, answer string, forced boolean"


#: Ordinals of a block: caps hold within a block, so a source of any size is many groups of bounded size.
BLOCK = 10_000
FAMILY_PROMPTS = {f: [p.replace("{x}", f"{{x}} {words}") for p in PROMPTS] for f, words in {"career": "at work", "relationship": "with someone close", "discipline": "in a daily habit", "fear_change": "when things change", "attachment": "when it is hard to let go", "purpose": "without a clear aim", "self_control": "in the heat of it", "inner_conflict": "while torn"}.items()}


def lessons(spark: SparkSession, data_dir: str) -> DataFrame:
    """source, block, ordinal, lesson, topic, families of every wisdom entry."""
    e = first_arrival(table(spark, data_dir, "wisdom_entries").select("id", "ingest_seq", "source_document_id", "distilled_wisdom", "extracted_principle", "philosophical_tags"))
    families = run_sql(spark, data_dir, scenario_families).select("id", F.split("families", "[|]").alias("families"))
    lesson = F.coalesce(F.nullif(F.trim("distilled_wisdom"), F.lit("")), F.nullif(F.trim("extracted_principle"), F.lit("")))
    topic = F.coalesce(F.get("philosophical_tags", F.lit(0)), F.lit("this"))
    rows = e.join(families, "id").select(F.coalesce("source_document_id", F.lit(-1)).alias("source"), F.col("id").alias("ordinal"), lesson.alias("lesson"), F.concat(topic, F.lit(" "), F.col("id") % 50).alias("topic"), "families")
    return rows.withColumn("block", F.expr(f"ordinal DIV {BLOCK}"))


BANKS = [OPENINGS, MIDDLES, ENDS]


def first_generator(rows: pd.DataFrame, earlier: pd.DataFrame | None = None) -> pd.DataFrame:
    return greedy.generate(rows, BANKS, PROMPTS, opening_cap=5, sentence_cap=3, attempts=40, per_lesson=1, fallback=True, earlier=earlier)


def generate_examples(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rotation over banks with caps of openings and sentences and a look back for similar answers; a forced example where all caps are reached."""
    return lessons(spark, data_dir).groupBy("source", "block").applyInPandas(lambda g: first_generator(g), EXAMPLE)


def generate_examples_b(spark: SparkSession, data_dir: str) -> DataFrame:
    """Openings in two examples at most, unused prompts first, no two answers of one fingerprint."""
    return lessons(spark, data_dir).groupBy("source", "block").applyInPandas(lambda g: greedy.generate_by_fingerprint(g, BANKS, PROMPTS, 2), EXAMPLE)


def generate_examples_c(spark: SparkSession, data_dir: str) -> DataFrame:
    """Families, structures and prompts combined, five examples a lesson at most, openings and actions in three at most."""
    return lessons(spark, data_dir).groupBy("source", "block").applyInPandas(lambda g: greedy.generate_by_family(g, BANKS, FAMILY_PROMPTS), EXAMPLE)


def regenerate_examples(spark: SparkSession, data_dir: str, offset: int = 100, limit: int = 100) -> DataFrame:
    """The examples of one slice of the lessons by ordinal, made again."""
    some = lessons(spark, data_dir).orderBy("ordinal").offset(offset).limit(limit)
    return some.groupBy("source", "block").applyInPandas(lambda g: first_generator(g), EXAMPLE)


def stream_generate_available_now(spark: SparkSession, data_dir: str) -> DataFrame:
    """Examples for lessons as they arrive: those that have examples are left out, and earlier examples of a block count for the caps of its new ones.

    The sink of the stream is read back before each batch; a replayed batch overwrites its own folder.
    """
    folder = new_folder(spark, "generate")
    sink = f"{folder}/sink"
    pool = cut_table(lessons(spark, data_dir))
    schema = T._parse_datatype_string(EXAMPLE + ", block long")

    def both(_: tuple, rows: pd.DataFrame, earlier: pd.DataFrame) -> pd.DataFrame:
        made = first_generator(rows, earlier) if len(rows) else pd.DataFrame(columns=[f.name for f in schema][:-1])
        return made.assign(block=rows["block"].iloc[0] if len(rows) else 0)

    def each(batch: DataFrame) -> DataFrame:
        earlier = written(spark, sink, schema)
        new = pool.join(batch.select(F.col("id").alias("ordinal")).distinct(), "ordinal", "left_semi").join(earlier.select("ordinal").distinct(), "ordinal", "left_anti")
        old = earlier.join(new.select("source", "block").distinct(), ["source", "block"], "left_semi")
        return cut(new.groupBy("source", "block").cogroup(old.groupBy("source", "block")).applyInPandas(both, schema))

    run_batches(example_stream(spark, data_dir, "wisdom_entries").select("id"), each, sink, f"{folder}/state")
    return written(spark, sink, schema).select(*[c.split()[0] for c in EXAMPLE.split(", ")])


def capped_assignment(spark: SparkSession, data_dir: str) -> DataFrame:
    """One rule text for each entry, no text more than twice in a block of a source; candidates are ranked by rule order."""
    low = X.column(lambda d, t: entry_text(d), "")
    candidates = F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(r)) for p, r in V.FIRST_MATCH]))
    e = first_arrival(table(spark, data_dir, "wisdom_entries").select("id", "ingest_seq", "source_document_id", "translation", "commentary", "extracted_principle"))
    rows = e.select(F.coalesce("source_document_id", F.lit(-1)).alias("source"), F.expr(f"id DIV {BLOCK}").alias("block"), F.col("id").alias("ordinal"), candidates.alias("candidates"))
    return rows.groupBy("source", "block").applyInPandas(lambda g: greedy.capped(g, 2), "source long, ordinal long, chosen string")


#: Rewrites in all, and for a theme.
TARGET, THEME_CAPS, THEME_CAP = 100, {"general": 8}, 6


def rewrite_accept(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rewrites under caps: the ordered pool is read one row after the other until the target is reached or every theme is full."""
    pool = run_sql(spark, data_dir, pool_sql).orderBy("place", "theme", "id")
    full = pool.select("theme").distinct().count() * max(THEME_CAP, *THEME_CAPS.values())
    rows = greedy.accept_rewrites(pool.toLocalIterator(), min(TARGET, full), THEME_CAPS, THEME_CAP, PROMPTS)
    return spark.createDataFrame(rows, "id long, theme string, prompt string")


def similar_pairs(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pairs of distilled sentences that are nearly the same."""
    e = first_arrival(table(spark, data_dir, "wisdom_entries"))
    return pairs_of(e, "id", "distilled_wisdom")


QUERIES = {f.__name__: f for f in (similar_pairs, generate_examples, generate_examples_b, generate_examples_c, regenerate_examples, stream_generate_available_now, capped_assignment, rewrite_accept)}
