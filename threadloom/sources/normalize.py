"""Scraped posts to the declared raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.coerce import iso_timestamp, list_or_empty, struct_or_null, to_long
from threadloom.schemas import QUORA_DATA, REDDIT_DATA, fields


def _reply(r: Column) -> Column:
    return F.struct(
        to_long(r["num_replies"]).alias("num_replies"),
        to_long(r["num_upvotes"]).alias("num_upvotes"),
        iso_timestamp(r["date_of_reply"]).alias("date_of_reply"),
        r["user_url"].alias("user_url"),
        r["reply"].alias("reply"),
        r["user_replying"].alias("user_replying"),
    )


def _comment(c: Column) -> Column:
    return F.struct(
        F.coalesce(F.transform(c["replies"], _reply), F.array()).alias("replies"),
        to_long(c["num_replies"]).alias("num_replies"),
        c["user_commenting"].alias("user_commenting"),
        to_long(c["num_upvotes"]).alias("num_upvotes"),
        iso_timestamp(c["date_of_comment"]).alias("date_of_comment"),
        c["url"].alias("url"),
        c["user_url"].alias("user_url"),
        c["comment"].alias("comment"),
    )


def _related(p: Column) -> Column:
    return F.struct(
        to_long(p["num_comments"]).alias("num_comments"),
        to_long(p["num_upvotes"]).alias("num_upvotes"),
        *[p[f].alias(f) for f in ("thumbnail", "url", "title", "community_url", "community")],
    )


def normalize_reddit(raw: DataFrame) -> DataFrame:
    """Wire rows plus ``snapshot_id`` to the Reddit table, in one projection."""
    special = {
        **{f: to_long(F.col(f)) for f in ("num_comments", "num_upvotes", "community_members_num", "post_karma")},
        **{f: iso_timestamp(F.col(f)) for f in ("date_posted", "timestamp")},
        **{f: list_or_empty(F.col(f)) for f in ("photos", "videos", "embedded_links")},
        "comments": F.coalesce(F.transform("comments", _comment), F.array()),
        "related_posts": F.coalesce(F.transform("related_posts", _related), F.array()),
        "community_rank": struct_or_null(F.col("community_rank"), ["community_rank_value", "community_rank_type"]),
        "input": struct_or_null(F.col("input"), ["url"]),
    }
    return raw.select(*[special.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields(REDDIT_DATA)])


def _answer(c: Column, nested: bool) -> Column:
    parts = [
        c["commenter_name"].alias("commenter_name"),
        c["comment"].alias("comment"),
        iso_timestamp(c["comment_date"]).alias("comment_date"),
    ]
    if nested:
        parts.append(F.coalesce(F.transform(c["replys"], lambda r: _answer(r, False)), F.array()).alias("replys"))
    return F.struct(*parts)


def normalize_quora(raw: DataFrame) -> DataFrame:
    """Wire rows plus ``snapshot_id`` to the Quora table: a projection with casts to the declared types."""
    special = {
        **{f: iso_timestamp(F.col(f)) for f in ("timestamp", "post_date")},
        **{f: to_long(F.col(f)) for f in ("views", "shares", "author_content_views", "upvotes", "over_all_answers")},
        "pictures_urls": list_or_empty(F.col("pictures_urls")),
        "top_comments": F.coalesce(F.transform("top_comments", lambda c: _answer(c, True)), F.array()),
    }
    return raw.select(*[special.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields(QUORA_DATA)])
