"""Links and id lists that a user pastes, and the scrape batches made of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import cut_query, has_text, trim_ws


def clean_links(df: DataFrame, col: str, distinct: bool = False) -> DataFrame:
    """Trim, drop blanks, cut at the first '?'. Duplicates stay unless ``distinct``."""
    cleaned = df.filter(has_text(F.col(col))).withColumn(col, cut_query(F.col(col)))
    return cleaned.dropDuplicates([col]) if distinct else cleaned


def scrape_manifest(links: DataFrame, initiated_at: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """The batches and the links of (dataset_id, snapshot_id, position, url).

    A batch is one row with its total and the time it was started; its links are one row each, in the order of
    ``position``. No row grows with a batch, so a batch may have any number of links.
    """
    batch = ["dataset_id", "snapshot_id"]
    headers = links.groupBy(*batch).agg(F.count(F.lit(1)).alias("total_urls_count")).withColumn(
        "initiated_at", F.lit(initiated_at).cast("timestamp")
    )
    return headers, links.select(*batch, "position", "url")


def selection(df: DataFrame, col: str) -> DataFrame:
    """The distinct non-blank ids of a pasted column, as ``unified_id``."""
    return df.filter(has_text(F.col(col))).select(trim_ws(F.col(col)).alias("unified_id")).distinct()
