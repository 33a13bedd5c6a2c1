"""From dropped files to enriched items in one job."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.enrich import LOOKBACK, pending_items
from threadloom.operators.flatten import PLATFORMS, platform_items
from threadloom.operators.merge import part_of, read_current
from threadloom.operators.skew import skew_join
from threadloom.plans.enrichment import Provider, enrich
from threadloom.schemas import EMBEDDINGS_CACHE
from threadloom.session import cut, discard
from threadloom.streaming.ingest import ingest_stream, reject_stream

# Raw rows are kept in so many parts by post; a batch reads those of its posts. More rows want more parts.
THREAD_PARTS = 16


def store_threads(raw: DataFrame, root: str, upto: int, parts: int = THREAD_PARTS) -> None:
    """Keep raw rows by post, in a folder of their own, so a repeated batch replaces itself."""
    placed = raw.filter(F.col("post_id").isNotNull()).withColumn("part", part_of("post_id", parts))
    placed.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{root}/upto={upto}")


def threads_of(spark: SparkSession, root: str, posts: DataFrame, parts: int = THREAD_PARTS) -> DataFrame:
    """All raw rows of the distinct ``posts(post_id)``; other parts of the store are not read, other threads not flattened."""
    touched = sorted(row[0] for row in posts.select(part_of("post_id", parts)).distinct().collect())
    return skew_join(spark.read.parquet(root).filter(F.col("part").isin(touched)), posts, "post_id", "left_semi").drop("part", "upto")


def _upto(spark: SparkSession, path: str) -> int:
    """The last batch whose items are done, or -1."""
    try:
        return spark.read.schema("batch_id bigint").parquet(path).agg(F.max("batch_id")).first()[0]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return -1
        raise


def enrich_batch(
    spark: SparkSession, platform: str, root: str, batch_id: int, as_of: dt.datetime, embed: Provider, score: Provider,
    lookback: dt.timedelta | None = LOOKBACK, parts: int = THREAD_PARTS,
) -> DataFrame:
    """Flatten and enrich the threads that changed since the last batch that was done; returns their items.

    A thread changed if it has a row in a batch after that, held-back batches included. An item's id fixes its thread, so the
    items of whole threads are those of the full view. Threads with an item that is still pending afterwards, as a provider
    failed on it, are taken again by the next batch. If anything fails, nothing is marked as done.
    """
    done = _upto(spark, f"{root}/done")
    rows = spark.read.parquet(f"{root}/raw").filter((F.col("outcome") == "accepted") & F.col("batch_id").between(done + 1, batch_id))
    fresh = rows.drop("stream", "batch_id", "outcome", "failed_rules")
    store_threads(fresh, f"{root}/threads", batch_id, parts)
    posts = fresh.select("post_id").filter(F.col("post_id").isNotNull())
    if done >= 0:
        posts = posts.unionByName(spark.read.schema("post_id string").parquet(f"{root}/again/upto={done}"))
    posts = cut(posts.distinct())
    items = cut(platform_items(threads_of(spark, f"{root}/threads", posts, parts), PLATFORMS[platform]))
    enrich(items, f"{root}/cache", as_of, embed, score, lookback)
    cache = read_current(spark, f"{root}/cache", f"{EMBEDDINGS_CACHE}, has_vector boolean")
    left = pending_items(items, cache, as_of, lookback).select("content_item_id")
    again = skew_join(items, left, "content_item_id", "left_semi").select(F.col("top_level_post_id").alias("post_id")).distinct()
    again.write.mode("overwrite").parquet(f"{root}/again/upto={batch_id}")
    spark.createDataFrame([(batch_id,)], "batch_id bigint").coalesce(1).write.mode("append").parquet(f"{root}/done")
    discard(posts)
    return items


def ingest_and_enrich(
    spark: SparkSession, drop_root: str, platform: str, root: str, as_of: dt.datetime, embed: Provider, score: Provider,
    lookback: dt.timedelta | None = LOOKBACK, files_per_batch: int | None = None, most_batches: int | None = None,
) -> DataFrame:
    """Take in what has been dropped, store what no platform takes, and enrich the changed threads after every good batch.

    Raw rows go to ``root/raw`` and, by post, to ``root/threads``, rejected files to ``root/rejects``, vectors and scores to
    the cache at ``root/cache``, which is returned. Running it again takes new files only. A batch reads and writes parts of the
    threads and the cache again, so ``most_batches`` bounds how often that happens in a backlog.
    """

    def enrich_new(batch_id: int) -> None:
        discard(enrich_batch(spark, platform, root, batch_id, as_of, embed, score, lookback))

    reject_stream(spark, drop_root, f"{root}/rejects", f"{root}/checkpoints", "rejects").awaitTermination()
    ingest_stream(
        spark, drop_root, platform, f"{root}/raw", f"{root}/checkpoints", "drops", on_success=enrich_new, files_per_batch=files_per_batch,
        most_batches=most_batches,
    ).awaitTermination()
    return read_current(spark, f"{root}/cache", EMBEDDINGS_CACHE)
