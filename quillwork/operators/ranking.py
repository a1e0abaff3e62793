"""Ranks and winners within groups of any size.

A window over a group would put a hot group into one task. Winners are aggregates with map-side combine; ranks come
from a range partitioning by group and order, which splits a hot group, with offsets from the counts of the parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwork.plans.lineage import cut


def winners(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """key, n (rows of the group), winner (the row that is first by the order, a struct). Order columns rank downwards; the last one must be unique."""
    best = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order))
    return df.groupBy(key).agg(F.count("*").alias("n"), best.alias("winner"))


def ranked_in_groups(df: DataFrame, key: str, order: list[Column], name: str = "place") -> DataFrame:
    """df with the place of each row in its group, counted from 1; order holds sort columns that make a total order."""
    parts = df.repartitionByRange(F.col(key), *order)
    parts = cut(parts.withColumn("_part", F.spark_partition_id()))
    within = parts.withColumn("_at", F.row_number().over(Window.partitionBy("_part", key).orderBy(*order)))
    counts = parts.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = before.select(F.col(key).alias("_key"), F.col("_part").alias("_p"), "_before")
    joined = within.join(offsets, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn(name, (F.col("_at") + F.col("_before")).cast("bigint")).drop("_part", "_at", "_key", "_p", "_before")
