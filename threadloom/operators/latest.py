"""Newest version per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key group under ``order``.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a key scraped millions
    of times costs one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def version_order(at: str, text: str) -> list[Column]:
    """Newest content first; load time, snapshot, text and score settle equal dates, so reruns agree."""
    return [
        F.col(at).desc_nulls_last(),
        F.col("record_load_timestamp").desc_nulls_last(),
        F.col("snapshot_id").desc_nulls_last(),
        F.col(text).asc_nulls_last(),
        F.col("upvotes").desc_nulls_last(),
        F.col("url").asc_nulls_last(),
    ]
