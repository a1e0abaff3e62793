"""Problem 6: records that are equal but for blanks, case, punctuation and the order of JSON fields.

Records get a canonical key, are range-partitioned and externally sorted by it, and each partition is
scanned once: adjacent rows are compared by their full keys, and every run gives one representative and its
exact number of copies. The id is part of the range, so a key that holds a third of all rows spreads over
many partitions; only the first and the last run of a partition can go on in a neighbour, and these two rows
a partition are merged afterwards. Nothing else is gathered.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.plans.lineage import cut
from quillwork.sources.tables import table

FIELD_END, PART_END = "\x02", "\x01"
SCAN_SCHEMA = "kind string, pid int, record_table string, first_id long, copy_id long, n long, edge boolean, seq int, key string"


def letters_and_digits(c: Column) -> Column:
    """What remains of a text once blanks, case and punctuation are disregarded; null stays null."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\p{M}]+", ""), "ß", "ss")


def plain(text: str) -> str:
    """letters_and_digits for one string."""
    import regex

    return regex.sub(r"[^\p{L}\p{N}\p{M}]+", "", text.lower()).replace("ß", "ss")


def line_key(line: str | None) -> str | None:
    """The key of a chat line; null unless the line is a JSON object with a non-empty list of messages.

    Fields of an object are put in order of their names; values that are no strings are compared as JSON.
    """

    def flat(x: object) -> str:
        if isinstance(x, dict):
            return PART_END.join(f"{k}={flat(v)}" for k, v in sorted(x.items()))
        return plain(x if isinstance(x, str) else json.dumps(x, sort_keys=True, ensure_ascii=False))

    try:
        record = json.loads(line) if line else None
    except (ValueError, RecursionError):
        return None
    if not isinstance(record, dict) or not isinstance(record.get("messages"), list) or not record["messages"]:
        return None
    tag = record.get("tag")
    return FIELD_END.join(flat(m) for m in record["messages"]) + FIELD_END + ("" if tag is None else flat(tag))


@F.pandas_udf(T.StringType())
def line_keys(lines: pd.Series) -> pd.Series:
    return lines.map(line_key, na_action="ignore")


def canonical_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """record_table, id, key of everything that is compared; a null text takes no part."""
    examples = table(spark, data_dir, "training_examples").select(
        F.lit("training_examples").alias("record_table"), F.col("id").cast("long").alias("id"), letters_and_digits(F.col("user_problem")).alias("key")
    )
    chats = table(spark, data_dir, "chat_records").select(
        F.lit("chat_records").alias("record_table"),
        F.col("record_id").cast("long").alias("id"),
        F.array_join(
            F.transform(
                "messages",
                lambda m: F.concat(F.coalesce(m.role, F.lit("")), F.lit(PART_END), F.coalesce(letters_and_digits(m.content), F.lit(""))),
            ),
            FIELD_END,
        ).alias("key"),
    )
    lines = table(spark, data_dir, "chat_lines").select(
        F.lit("chat_lines").alias("record_table"), F.col("line_id").cast("long").alias("id"), line_keys("line_text").alias("key")
    )
    return examples.unionByName(chats).unionByName(lines).where("key is not null and id is not null")


def _scan(with_copies: bool):
    """The scan of one sorted partition. Runs are numbered by seq; the first and the last are edges and carry their key."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        open_run: list | None = None  # table, key, first id, rows so far, seq

        def closed(run: list, edge: bool) -> tuple:
            return ("run", pid, run[0], run[2], None, run[3], edge, run[4], edge_key(run[1]) if edge else None)

        for b in batches:
            out: list[tuple] = []
            for tab, key, i in zip(b["record_table"].to_numpy(), b["key"].to_numpy(), b["id"].to_numpy()):
                if open_run is not None and open_run[1] == key and open_run[0] == tab:
                    open_run[3] += 1
                    if with_copies:
                        out.append(("copy", pid, tab, open_run[2], int(i), 1, open_run[4] == 0, open_run[4], None))
                    continue
                if open_run is not None and (open_run[3] > 1 or open_run[4] == 0):
                    out.append(closed(open_run, open_run[4] == 0))
                open_run = [tab, key, int(i), 1, 0 if open_run is None else open_run[4] + 1]
            if out:
                yield _frame(out)
        if open_run is not None:
            yield _frame([closed(open_run, True)])

    return scan


def edge_key(key: str) -> str:
    """What stands for the key of a run at the edge of a partition: 128 bits, so that the few edges are light however long the keys are."""
    import xxhash

    return xxhash.xxh3_128_hexdigest(key.encode("utf-8", "surrogatepass"))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["kind", "pid", "record_table", "first_id", "copy_id", "n", "edge", "seq", "key"])
    return frame.astype({"copy_id": "Int64", "seq": "int32", "pid": "int32"})


def scanned_runs(records: DataFrame, with_copies: bool) -> tuple[DataFrame, DataFrame]:
    """(scan, edges): the rows of all scans, and for each run at the edge of a partition its whole group's first id and size.

    records: record_table, id, key. The sort columns hold a prefix and a hash of the key, not the key, so the sample
    by which Spark draws the ranges stays small; within a partition rows are sorted by the whole key.
    """
    ranged = records.select(
        "record_table", "id", "key", F.left("key", F.lit(32)).alias("_prefix"), F.xxhash64("key").alias("_hash")
    )
    order = ["record_table", "_prefix", "_hash"]
    sorted_ = ranged.repartitionByRange(*order, "id").sortWithinPartitions(*order, "key", "id").select("record_table", "key", "id")
    scan = cut(sorted_.mapInPandas(_scan(with_copies), SCAN_SCHEMA))  # the ranges are drawn from a sample: run once
    edges = scan.where("kind = 'run' and edge")
    across = Window.orderBy("pid", "seq")  # at most two rows a partition, whatever the number of records
    same = (F.col("key") == F.lag("key").over(across)) & (F.col("record_table") == F.lag("record_table").over(across))
    numbered = edges.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn(
        "_group", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, 0))
    )
    whole = Window.partitionBy("_group")
    edges = numbered.select(
        "pid", "seq", "record_table", F.col("first_id").alias("run_first"), F.min("first_id").over(whole).alias("group_first"), F.sum("n").over(whole).alias("group_n")
    )
    return scan, edges


def format_copy_groups(records: DataFrame) -> DataFrame:
    """One row for each group of equal records, single records included: record_table, first_id, n_records.

    Only groups of two or more are kept apart by the scan; the count is exact for groups of any size.
    """
    scan, edges = scanned_runs(records, with_copies=False)
    inner = scan.where("kind = 'run' and not edge").select("record_table", "first_id", F.col("n").alias("n_records"))
    outer = edges.groupBy("record_table", F.col("group_first").alias("first_id")).agg(F.max("group_n").alias("n_records"))
    return inner.unionByName(outer).where("n_records > 1")


def format_copies(records: DataFrame) -> DataFrame:
    """record_table, first_id, copy_id: each record that has an equal one of smaller id in its table."""
    scan, edges = scanned_runs(records, with_copies=True)
    copies = scan.where("kind = 'copy'")
    firsts = F.broadcast(edges.select("pid", "seq", "group_first"))  # two rows a partition
    inside = copies.join(firsts, ["pid", "seq"], "left").select(
        "record_table", F.coalesce("group_first", "first_id").alias("first_id"), "copy_id"
    )
    later = edges.where("run_first <> group_first").select("record_table", F.col("group_first").alias("first_id"), F.col("run_first").alias("copy_id"))
    return inside.unionByName(later)


def p6_found(spark: SparkSession, data_dir: str) -> DataFrame:
    return format_copies(canonical_records(spark, data_dir))


def p6_groups(spark: SparkSession, data_dir: str) -> DataFrame:
    return format_copy_groups(canonical_records(spark, data_dir))


#: training_examples only: the chat tables need JSON and lambdas over nested lists, which tests compare with brute force.
P6_PROMPT_GROUPS_SQL = """
SELECT min(id) AS first_id, count(*) AS n_records FROM training_examples WHERE user_problem IS NOT NULL
GROUP BY replace(regexp_replace(lower(user_problem), '[^\\p{L}\\p{N}\\p{M}]+', '', 'g'), 'ß', 'ss') HAVING count(*) > 1
"""


def p6_prompt_groups(spark: SparkSession, data_dir: str) -> DataFrame:
    """Groups among the prompts alone, which SQL can check."""
    prompts = canonical_records(spark, data_dir).where("record_table = 'training_examples'")
    return format_copy_groups(prompts).select("first_id", "n_records")
