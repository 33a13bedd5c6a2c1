"""Summary tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.enrich import sentiment_label
from threadloom.operators.skew import skew_join

# How a row of the enriched table came about.
AD_HOC = "ad_hoc_consultant"
SCHEDULED = "scheduled_general"


def enriched_items(
    items: DataFrame, cache: DataFrame, as_of: dt.datetime, keyword_lists: DataFrame | None = None,
    assignments: DataFrame | None = None, labels: DataFrame | None = None, run_id: str | None = None,
    text_col: str = "full_text_context", threshold: float = 0.25,
) -> DataFrame:
    """Items with sentiment, keywords and, for a run, their topic and its label. All joins keep every item.

    Item ids are unique on both sides. A run has as many labels as topics: they go to the items as one value, so items
    without a topic, or with one that most items share, meet in no task.
    """
    scores = cache.select(F.col("unified_id").alias("content_item_id"), "sentiment_score")
    wide = items.join(scores, "content_item_id", "left")
    if keyword_lists is not None:
        wide = wide.join(keyword_lists.select("content_item_id", "keyword_list"), "content_item_id", "left")
    else:
        wide = wide.withColumn("keyword_list", F.lit(None).cast("array<string>"))
    if run_id is not None and assignments is not None:
        topics = assignments.filter(F.col("run_id") == run_id).select(F.col("unified_id").alias("content_item_id"), "topic_id")
        wide = wide.join(topics, "content_item_id", "left")
    else:
        wide = wide.withColumn("topic_id", F.lit(None).cast("bigint"))
    if run_id is not None and labels is not None:
        of_run = labels.filter((F.col("run_id") == run_id) & F.col("topic_id").isNotNull())
        names = of_run.agg(F.map_from_entries(F.collect_list(F.struct("topic_id", "topic_label")))).scalar()
        wide = wide.withColumn("_names", names).withColumn("topic_label", F.try_element_at("_names", F.col("topic_id"))).drop("_names")
    else:
        wide = wide.withColumn("topic_label", F.lit(None).cast("string"))
    return wide.select(
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(SCHEDULED if run_id is None else AD_HOC).alias("processing_type"),
        "source", "content_type", "content_item_id", "parent_content_item_id", "top_level_post_id",
        F.lit(as_of).cast("timestamp").alias("analysis_timestamp"),
        F.col(text_col).alias("text_analyzed_for_nlp"),
        sentiment_label(F.col("sentiment_score"), threshold).alias("sentiment_label"),
        "sentiment_score", "topic_id", "topic_label",
        F.coalesce("keyword_list", F.array().cast("array<string>")).alias("keyword_list"),
    )


def topic_summary(assignments: DataFrame, labels: DataFrame) -> DataFrame:
    """Size, mean distance and mean sentiment per topic, with its label; aggregated before the join."""
    summed = assignments.groupBy("run_id", "topic_id").agg(
        F.count(F.lit(1)).alias("num_documents"),
        F.avg("assignment_score").alias("avg_assignment_score"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
        F.avg("sentiment_magnitude").alias("avg_sentiment_magnitude"),
    )
    named = labels.select("run_id", "topic_id", "topic_label", "topic_description", "confidence_score")
    return summed.join(named, ["run_id", "topic_id"], "left")


def sentiment_trend(assignments: DataFrame) -> DataFrame:
    """Volume and mean sentiment per day, source and topic."""
    return assignments.groupBy(
        "run_id", F.to_date("content_timestamp").alias("day"), "source", "topic_id"
    ).agg(
        F.count(F.lit(1)).alias("num_documents"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
        F.sum("sentiment_magnitude").alias("sentiment_magnitude"),
    )


def map_view(coordinates: DataFrame, assignments: DataFrame, labels: DataFrame) -> DataFrame:
    """Map points with their document's topic and label."""
    placed = coordinates.select("run_id", "unified_id", "umap_x", "umap_y").join(
        assignments.select("run_id", "unified_id", "source", "content_type", "primary_text", "topic_id", "sentiment_score"),
        ["run_id", "unified_id"],
    )
    return skew_join(placed, labels.select("run_id", "topic_id", "topic_label"), ["run_id", "topic_id"])
