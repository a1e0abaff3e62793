"""Problem 2: cut oversized items into overlapping pieces at natural boundaries.

One bounded-quantifier regular expression consumes the text: its alternatives are ordered by boundary
strength (rest of the text, paragraph, sentence, line, clause, blank) and each may take up to the limit;
the last alternatives fall back to characters, not between a letter and its combining mark. The cuts and
the overlaps are SQL array functions, so the operator is a narrow JVM projection: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.sources.tables import first_arrival, table

#: Boundaries in order of strength, each as a look-behind of bounded length.
BOUNDARIES = (
    r"(?<=\n[ \t\r]{0,8}\n)",
    r"(?<=[.!?…][\"'”’»)\]]{0,3}\s)|(?<=[。！？।॥])(?![。！？।॥”’」』）)])|(?<=[。！？।॥][”’」』）)])",
    r"(?<=\n)",
    r"(?<=[,;:]\s)|(?<=[，；：、])",
    r"(?<=\s)",
)


def cutting_pattern(max_chars: Column, overlap: Column) -> Column:
    """The pattern for pieces whose own part has at most max_chars - overlap characters.

    A boundary counts if it leaves the piece at least half full; hence every own part but the last is
    at least as long as the overlap, and the look-back stays within the piece before.
    """
    most = (max_chars - overlap).cast("string")
    least = F.greatest(F.floor((max_chars - overlap) / 2), overlap, F.lit(1)).cast("string")
    parts = [F.lit("(?s).{1,"), most, F.lit("}\\z")]
    for b in BOUNDARIES:
        parts += [F.lit("|.{"), least, F.lit(","), most, F.lit("}(?:" + b + ")")]
    parts += [F.lit("|.{"), least, F.lit(","), most, F.lit("}(?!\\p{M})|.{1,"), most, F.lit("}")]
    return F.concat(*parts)


def split_pieces(df: DataFrame, text: str, max_chars: Column, overlap_chars: Column, out: str = "pieces") -> DataFrame:
    """Add array column `out` of struct(piece_no, start_char, piece) in text order.

    A null text gives null; a text within the limit gives itself as its one piece, '' included. The overlap
    is held to half the limit and a limit under 2 counts as 2, so that every piece moves on. start_char is
    the 0-based offset of the piece, its overlap included; characters are Unicode code points.
    """
    limit = F.greatest(max_chars.cast("int"), F.lit(2))
    lap = F.greatest(F.least(overlap_chars.cast("int"), F.floor(limit / 2).cast("int")), F.lit(0))
    t = F.col(f"`{text}`")
    small = F.length(t) <= limit
    own = F.when(small, F.array(t)).otherwise(F.regexp_extract_all(t, cutting_pattern(limit, lap), F.lit(0)))
    df = df.withColumn("_own", own).withColumn("_lap", lap)
    ends = F.aggregate(
        F.transform("_own", F.length),
        F.array(F.lit(0)),
        lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)),
    )
    df = df.withColumn("_ends", ends)
    piece = F.transform(
        "_own",
        lambda x, i: F.when(
            i == 0, F.struct((i + 1).alias("piece_no"), F.lit(0).alias("start_char"), x.alias("piece"))
        ).otherwise(
            F.struct(
                (i + 1).alias("piece_no"),
                (F.get("_ends", i) - F.col("_lap")).alias("start_char"),
                F.concat(F.right(F.get("_own", i - 1), F.col("_lap")), x).alias("piece"),
            )
        ),
    )
    return df.withColumn(out, piece).drop("_own", "_lap", "_ends")


def item_pieces(spark: SparkSession, data_dir: str, arrived_once: bool) -> DataFrame:
    """item_table, item_id, pieces of every item whose field split_limits names; of several limits for a field the smallest stands.

    Limits are scalar subqueries, so there is no join. With arrived_once replayed rows are merged before they are cut.
    """
    limits = table(spark, data_dir, "split_limits")
    out = None
    for name, field in (("extracted_document_texts", "raw_text"), ("document_chunks", "content")):
        items = table(spark, data_dir, name).select("id", "ingest_seq", F.col(field).alias("text"))
        if arrived_once:
            items = first_arrival(items)
        own = limits.where((F.col("item_table") == name) & (F.col("item_field") == field))
        limit = own.select(F.min(F.struct("max_chars", "overlap_chars")).alias("x"))
        items = items.select(F.lit(name).alias("item_table"), F.col("id").alias("item_id"), "text", limit.select("x.max_chars").scalar().alias("max_chars"), limit.select("x.overlap_chars").scalar().alias("overlap_chars"))
        cut = split_pieces(items.where("max_chars is not null"), "text", F.col("max_chars"), F.col("overlap_chars")).select("item_table", "item_id", "pieces")
        out = cut if out is None else out.unionByName(cut)
    return out


def p2_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Items that the cutting operator divides, each once."""
    return item_pieces(spark, data_dir, False).where(F.size("pieces") > 1).select("item_table", "item_id").distinct()


def p2_pieces(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every piece of every item."""
    return item_pieces(spark, data_dir, True).select("item_table", "item_id", F.size("pieces").alias("n_pieces"), F.inline("pieces")).withColumn("n_chars", F.length("piece"))


P2_FOUND_SQL = """
SELECT DISTINCT item_table, item_id FROM (
  SELECT 'extracted_document_texts' AS item_table, id AS item_id, length(raw_text) AS n FROM extracted_document_texts
  UNION ALL SELECT 'document_chunks', id, length(content) FROM document_chunks) JOIN split_limits USING (item_table)
WHERE n > max_chars
"""
