"""The incremental enrichment job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from threadloom.operators.enrich import CACHE_COLUMNS, LOOKBACK, combine_enrichment, pending_items
from threadloom.operators.merge import merge_into, read_current
from threadloom.schemas import EMBEDDINGS_CACHE
from threadloom.session import cut, discard

# A provider takes (content_item_id, content) and returns it with its results and a status, empty when fine.
Provider = Callable[[DataFrame], DataFrame]


def enrich(
    items: DataFrame, cache_root: str, as_of: dt.datetime, embed: Provider, score: Provider,
    lookback: dt.timedelta | None = LOOKBACK, text_col: str = "primary_text",
) -> DataFrame:
    """Enrich what is pending, merge it into the cache below ``cache_root`` and return the cache.

    The search for pending items reads keys, scores and a flag of the cache; the merge rewrites the touched buckets only.
    Running it again with the same items changes nothing: nothing is pending, and known values are kept.
    """
    spark = items.sparkSession
    cache = read_current(spark, cache_root, f"{EMBEDDINGS_CACHE}, has_vector boolean")
    # Both providers read the pending items, so they are written once.
    pending = cut(pending_items(items, cache, as_of, lookback, text_col))
    if not pending.isEmpty():
        results = combine_enrichment(embed(pending), score(pending), as_of)
        merge_into(results, cache_root, "unified_id", CACHE_COLUMNS, EMBEDDINGS_CACHE, {"has_vector": "embeddings"})
    discard(pending)
    return read_current(spark, cache_root, EMBEDDINGS_CACHE)
