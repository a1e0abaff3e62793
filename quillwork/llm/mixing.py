"""Problem 9: mixing sources to target shares of the total tokens, with capped repeats and a report of actual shares.

Every document has a hash position in [0, 1). A mix takes from each source whole passes over it and, of one more
pass, the documents below a threshold, so nested budgets give nested selections and nothing is sorted. The threshold
comes from histograms: tokens are summed by source and hash bucket, the running sum finds the bucket in which the
budget falls, and only that bucket is refined into finer buckets, again by hash, until it is as fine as the hash.

The size of a mix is the largest at which every source can still give its share: the least of
(tokens of a source x its repeats / its share). A source without documents cannot give any; it is reported with a
share of 0 and the size is taken over the sources that exist.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.plans.lineage import cut
from quillwork.sources.tables import table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Words and runs that the byte-level vocabulary was made for.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEVEL_BITS, LEVELS = 10, 3


def token_counter(spark: SparkSession, path: str):
    """A pandas function that counts the tokens of texts; the vocabulary file is sent to the workers and read once by each. Null and '' count 0."""
    spark.sparkContext.addFile(path)
    name = path.rpartition("/")[2]

    @F.pandas_udf(T.LongType())
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        for s in texts:
            yield s.map(lambda t: len(encoding.encode_ordinary(t)) if t else 0)

    return count


def sized_documents(spark: SparkSession, data_dir: str, tokenizer: str | None = None) -> DataFrame:
    """The vocabulary file is a parameter, of the function or of the session (quillwork.tokenizer). doc_id, source, tokens, position (30 bits of a hash of the id)."""
    docs = table(spark, data_dir, "documents").select("doc_id", "source", "text")
    bits = LEVEL_BITS * LEVELS
    return docs.select("doc_id", "source", token_counter(spark, tokenizer or spark.conf.get("quillwork.tokenizer", TOKENIZER))("text").alias("tokens"), F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits).alias("position"))


def source_budgets(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """For each mix and source: available tokens, budget, whole passes and the tokens left for a part pass.

    targets: mix_name, source, target_share, max_repeats. Shares are taken relative to the sum over sources that
    exist; repeated target rows are merged. A null source takes no part.
    """
    have = docs.where("source is not null").groupBy("source").agg(F.sum("tokens").alias("available"), F.count("*").alias("n_documents"))
    goals = targets.where("source is not null and target_share > 0 and max_repeats > 0").groupBy("mix_name", "source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    both = goals.join(have, "source", "left").fillna(0, ["available", "n_documents"])
    mix = Window.partitionBy("mix_name")  # one row a source: a small table whatever the corpus
    real = F.when(F.col("available") > 0, F.col("target_share"))
    share = real / F.sum(real).over(mix)
    size = F.min(F.col("available") * F.col("max_repeats") / share).over(mix)
    budget = F.coalesce(F.floor(size * share + 1e-6), F.lit(0)).cast("long")
    passes = F.when(F.col("available") > 0, F.least(F.floor(budget / F.col("available")), F.col("max_repeats").cast("long"))).otherwise(0).cast("long")
    return both.withColumn("budget", budget).withColumn("passes", passes).withColumn("rest", F.col("budget") - F.col("passes") * F.col("available"))


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each mix and source the position below which the part pass takes documents.

    One level: the histogram of tokens over the buckets of the boundary bucket found so far; the bucket is chosen
    whose running sum first exceeds what is left. After the last level a bucket is a single hash position.
    """
    found = budgets.select("mix_name", "source", F.col("rest"), F.lit(0).cast("long").alias("base"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        # pre-aggregated by source and bucket: at most 2^LEVEL_BITS rows a boundary bucket; a hot source needs no salt
        if level == 0:
            hist = docs.groupBy("source", F.shiftright("position", shift).alias("bucket")).agg(F.sum("tokens").alias("t"))
            hist = found.join(hist, "source")
        else:
            inside = F.shiftright(F.col("position"), shift + LEVEL_BITS) == F.col("base")
            hist = docs.join(found, "source").where(inside).groupBy("mix_name", "source", "rest", "base", F.shiftright("position", shift).alias("bucket")).agg(F.sum("tokens").alias("t"))
        run = Window.partitionBy("mix_name", "source").orderBy("bucket")
        upto = hist.withColumn("upto", F.sum("t").over(run))
        # the first bucket that would exceed the rest; what lies before it is taken whole
        cut = upto.where(F.col("upto") > F.col("rest")).groupBy("mix_name", "source").agg(F.min_by(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("t")).alias("left")), "bucket").alias("b"))
        found = found.select("mix_name", "source").join(cut, ["mix_name", "source"], "left").select("mix_name", "source", F.coalesce("b.left", F.lit(0)).alias("rest"), F.coalesce("b.bucket", F.lit(-1)).cast("long").alias("base"))
    return found.select("mix_name", "source", F.col("base").alias("below"))


def mixed_documents(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """mix_name, source, doc_id, tokens, copies: how often each document is used; a filter over hash positions.

    The plan is broadcast where its size at run time allows, else a hot source is split by the adaptive skew join.
    """
    plan = source_budgets(docs, targets)
    plan = plan.join(thresholds(docs, plan.where("rest > 0 and available > 0")), ["mix_name", "source"], "left").select("mix_name", "source", "passes", F.coalesce("below", F.lit(0)).alias("below"))
    copies = F.col("passes") + F.when(F.col("position") < F.col("below"), 1).otherwise(0)
    return docs.join(plan, "source").withColumn("copies", copies).where("copies > 0").select("mix_name", "source", "doc_id", "tokens", "copies")


def p9_shares(spark: SparkSession, data_dir: str) -> DataFrame:
    """The report: target and actual share of each source of each mix."""
    docs = cut(sized_documents(spark, data_dir))  # four narrow columns: texts are tokenized once
    targets = table(spark, data_dir, "mix_targets")
    used = mixed_documents(docs, targets).groupBy("mix_name", "source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("n_records"), F.max("copies").alias("most_repeats"))
    goals = targets.where("source is not null").groupBy("mix_name", "source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    report = goals.join(used, ["mix_name", "source"], "left").fillna(0, ["tokens", "n_records", "most_repeats"])
    return report.withColumn("actual_share", F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy("mix_name")), F.lit(0)))


def p9_members(spark: SparkSession, data_dir: str) -> DataFrame:
    """The documents of every mix with their copies."""
    return mixed_documents(cut(sized_documents(spark, data_dir)), table(spark, data_dir, "mix_targets"))
