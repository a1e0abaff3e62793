"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The table `name` of `data_dir`, lazily; filters and columns are pushed into the scan."""
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def first_arrival(df: DataFrame, key: str = "id", order: str = "ingest_seq") -> DataFrame:
    """One row for each key: a replayed row repeats an earlier one and counts once.

    The aggregate keeps the earliest arrival (smallest `order`, nulls last); map-side combine
    means that copies of a hot key are merged before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(f"`{c}`") for c in others])
    rank = F.coalesce(F.col(order), F.lit(2**62)) if order in df.columns else F.lit(0)
    best = df.groupBy(key).agg(F.min_by(packed, rank).alias("_row"))
    return best.select(key, *[F.col("_row").getField(c).alias(c) for c in others]).select(*df.columns)
