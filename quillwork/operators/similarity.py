"""Similarity of sequences: pairs whose matching-block ratio reaches a threshold.

The ratio 2M / (a + b) has two upper bounds that need no alignment: the lengths alone, and the shared characters.
Lengths are put into bands so that the join is an equi-join on neighbouring bands; the character bound is a JVM
expression over counts; only what passes both is aligned, in batches.
"""

from __future__ import annotations

import difflib
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LETTERS = "abcdefghijklmnopqrstuvwxyz "


@F.pandas_udf(T.DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([1.0 if x == y else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype=float)


def similar_pairs(df: DataFrame, key: str, text: str, least: float = 0.92) -> DataFrame:
    """key_a < key_b and ratio for every pair of texts of that ratio or more.

    Texts are lowered and collapsed; null and blank ones take no part. Equal texts are merged before the join and
    given back as links of their class: key_a and key_b are the smallest keys of two classes, n_a and n_b their sizes.
    """
    norm = F.trim(F.regexp_replace(F.lower(F.col(text)), r"\s+", " "))
    classes = df.select(F.col(key).alias("k"), norm.alias("t")).where("t <> ''").groupBy("t").agg(F.min("k").alias("k"), F.count("*").alias("n"))
    # a partner is at most `widest` times as long, so it lies in the same band or a neighbouring one
    widest = least / (2 - least)
    band = F.floor(F.log(F.length("t")) / -math.log(widest)).cast("int")
    counts = F.array(*[F.length("t") - F.length(F.replace("t", F.lit(c), F.lit(""))) for c in LETTERS])
    rows = classes.select("k", "n", "t", F.length("t").alias("size"), band.alias("band"), counts.alias("c"))
    left = rows.select(*[F.col(c).alias(f"{c}_a") for c in rows.columns], F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("join_band"))
    right = rows.select(*[F.col(c).alias(f"{c}_b") for c in rows.columns])
    total = F.col("size_a") + F.col("size_b")
    other = F.abs((F.col("size_a") - F.aggregate("c_a", F.lit(0), lambda a, x: a + x)) - (F.col("size_b") - F.aggregate("c_b", F.lit(0), lambda a, x: a + x)))
    apart = F.aggregate(F.zip_with("c_a", "c_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda a, x: a + x) + other
    pairs = (
        left.join(right, F.col("join_band") == F.col("band_b"))
        .where((F.col("k_a") < F.col("k_b")) & (2 * F.least("size_a", "size_b") >= least * total) & (total - apart >= least * total - 1e-9))
        .withColumn("ratio", block_ratio("t_a", "t_b"))
        .where(F.col("ratio") >= least)
    )
    return pairs.select(F.col("k_a").alias("key_a"), F.col("k_b").alias("key_b"), F.col("n_a"), F.col("n_b"), "ratio")
