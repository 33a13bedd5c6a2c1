"""Nested threads to one row per post, comment and reply."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.coerce import list_or_empty
from threadloom.functions.ids import stable_id
from threadloom.operators.latest import latest_by, version_order
from threadloom.operators.skew import skew_join
from threadloom.session import cut


@dataclass(frozen=True)
class Level:
    """Where one level of a thread keeps its fields; None means the platform has no such field."""

    author: str
    text: str
    at: str
    upvotes: str | None = None
    url: str | None = None
    children: str | None = None


@dataclass(frozen=True)
class Platform:
    source: str
    title: str
    post: Level
    comment: Level
    reply: Level
    media: str
    videos: str
    community: str | None
    # The reply id hashes the author in place of the text on this platform (kept for equal ids).
    reply_id_repeats_author: bool = False


REDDIT = Platform(
    source="Reddit",
    title="title",
    post=Level("user_posted", "description", "date_posted", "num_upvotes", "url", "comments"),
    comment=Level("user_commenting", "comment", "date_of_comment", "num_upvotes", "url", "replies"),
    reply=Level("user_replying", "reply", "date_of_reply", "num_upvotes", "user_url"),
    media="photos",
    videos="videos",
    community="community_name",
    reply_id_repeats_author=True,
)

QUORA = Platform(
    source="Quora",
    title="title",
    post=Level("author_name", "post_text", "post_date", "upvotes", "url", "top_comments"),
    comment=Level("commenter_name", "comment", "comment_date", children="replys"),
    reply=Level("commenter_name", "comment", "comment_date"),
    media="pictures_urls",
    videos="videos_urls",
    community=None,
)


PLATFORMS = {platform.source: platform for platform in (REDDIT, QUORA)}


def _field(parent: str, name: str | None, type_: str) -> Column:
    if name is None:
        return F.lit(None).cast(type_)
    return F.col(f"{parent}.{name}" if parent else name).cast(type_)


def media_list(df: DataFrame, name: str) -> Column:
    """An array column as it is (never NULL); a single address as a list of one or none."""
    if df.schema[name].dataType.typeName() == "array":
        return list_or_empty(F.col(name))
    return F.when(F.col(name).isNotNull(), F.array(F.col(name))).otherwise(F.array().cast("array<string>"))


def posts_base(raw: DataFrame, platform: Platform) -> DataFrame:
    """Post versions that have an id and a title or a body."""
    level = platform.post
    kept = raw.filter(F.col("post_id").isNotNull() & (F.col(platform.title).isNotNull() | F.col(level.text).isNotNull()))
    return kept.select(
        "post_id",
        F.col(level.url).alias("url"),
        F.col(level.author).alias("author"),
        F.col(platform.title).alias("title"),
        F.col(level.text).alias("body"),
        F.col(level.upvotes).cast("bigint").alias("upvotes"),
        F.col(level.at).alias("at"),
        _field("", platform.community, "string").alias("community"),
        media_list(kept, platform.media).alias("media_urls"),
        media_list(kept, platform.videos).alias("video_urls"),
        F.col("timestamp").alias("record_load_timestamp"),
        "snapshot_id",
        F.col(level.children).alias("children"),
    )


def _unnest(df: DataFrame, keep: list[str], array: str, fields: list[str | None]) -> DataFrame:
    """One row per element of ``array``, as struct ``e`` of the named fields.

    Zipping the single fields instead of exploding the whole struct keeps all other nested columns out of the
    scan: a comment pass does not read the replies.
    """
    names = [f for f in fields if f]
    zipped = F.arrays_zip(*[F.col(f"{array}.{f}") for f in names])
    return df.select(*keep, F.explode(zipped).alias("e"))


def comments_base(posts: DataFrame, platform: Platform, with_replies: bool = True) -> DataFrame:
    """Comment versions of the kept post versions, with their stable ids. Empty and NULL lists give no rows."""
    level = platform.comment
    fields = [level.author, level.text, level.at, level.upvotes, level.url]
    keep = ["post_id", "record_load_timestamp", "snapshot_id"]
    rows = _unnest(posts, keep, "children", fields + [level.children if with_replies else None])
    flat = rows.filter(F.col(f"e.{level.text}").isNotNull()).select(
        *keep,
        _field("e", level.url, "string").alias("url"),
        F.col(f"e.{level.author}").alias("author"),
        F.col(f"e.{level.text}").alias("text"),
        _field("e", level.upvotes, "bigint").alias("upvotes"),
        F.col(f"e.{level.at}").alias("at"),
        *([F.col(f"e.{level.children}").alias("children")] if with_replies else []),
    )
    prefix = f"{platform.source.lower()}_comment_gen_"
    return flat.withColumn("comment_id", stable_id(prefix, F.col("post_id"), F.col("author"), F.col("at"), F.col("text")))


def replies_base(comments: DataFrame, platform: Platform, reply_id_includes_text: bool = False) -> DataFrame:
    """Reply versions of the kept comment versions, with their stable ids.

    Where the platform's id repeats the author, two replies of one author in one second to one comment share an
    id; ``reply_id_includes_text`` hashes the text instead.
    """
    level = platform.reply
    keep = ["post_id", "comment_id", "comment_text", "record_load_timestamp", "snapshot_id"]
    rows = _unnest(comments.withColumnRenamed("text", "comment_text"), keep, "children", [level.author, level.text, level.at, level.upvotes, level.url])
    flat = rows.filter(F.col(f"e.{level.text}").isNotNull()).select(
        *keep,
        _field("e", level.url, "string").alias("url"),
        F.col(f"e.{level.author}").alias("author"),
        F.col(f"e.{level.text}").alias("text"),
        _field("e", level.upvotes, "bigint").alias("upvotes"),
        F.col(f"e.{level.at}").alias("at"),
    )
    last = "author" if platform.reply_id_repeats_author and not reply_id_includes_text else "text"
    prefix = f"{platform.source.lower()}_reply_gen_"
    return flat.withColumn(
        "reply_id", stable_id(prefix, F.col("comment_id"), F.col("author"), F.col("at"), F.col(last))
    )


def latest_posts(posts: DataFrame) -> DataFrame:
    return latest_by(posts.drop("children"), ["post_id"], version_order("at", "title"))


def latest_comments(comments: DataFrame) -> DataFrame:
    return latest_by(comments, ["comment_id"], version_order("at", "text"))


def latest_replies(replies: DataFrame) -> DataFrame:
    return latest_by(replies, ["reply_id"], version_order("at", "text"))


def project_posts(best_posts: DataFrame, platform: Platform) -> DataFrame:
    """Newest posts as items. The text is the title alone; the body is the context."""
    return _items(
        best_posts.select(
            "*",
            F.lit("post").alias("content_type"),
            F.col("post_id").alias("content_item_id"),
            F.lit(None).cast("string").alias("parent_content_item_id"),
            F.col("title").alias("primary_text"),
            F.col("body").alias("full_text_context"),
        ),
        platform,
    )


def _comment_rows(best_comments: DataFrame) -> DataFrame:
    return best_comments.select(
        F.lit("comment").alias("content_type"),
        F.col("comment_id").alias("content_item_id"),
        F.col("post_id").alias("parent_content_item_id"),
        "post_id", "url", "author", "text", "upvotes", "at",
        F.col("text").alias("own_context"),
    )


def _reply_rows(best_replies: DataFrame) -> DataFrame:
    return best_replies.select(
        F.lit("reply").alias("content_type"),
        F.col("reply_id").alias("content_item_id"),
        F.col("comment_id").alias("parent_content_item_id"),
        "post_id", "url", "author", "text", "upvotes", "at",
        F.concat("comment_text", F.lit(" "), "text").alias("own_context"),
    )


def _project_children(children: DataFrame, best_posts: DataFrame, platform: Platform) -> DataFrame:
    """Comments and replies with the context of their newest post.

    A comment's id covers its text, so a reply brings its comment's text along from its own record and one join
    with the posts serves both levels.
    """
    none = F.array().cast("array<string>")
    context = best_posts.select(
        "post_id",
        F.col("url").alias("post_url"),
        F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit(""))).alias("thread"),
        "community",
        "record_load_timestamp",
        "snapshot_id",
        none.alias("media_urls"),
        none.alias("video_urls"),
    )
    joined = skew_join(children, context, "post_id")
    own_url = {"comment": platform.comment.url, "reply": platform.reply.url}
    with_url = F.col("content_type").isin([kind for kind, field in own_url.items() if field])
    return _items(
        joined.withColumns(
            {
                "url": F.when(with_url, F.col("url")).otherwise(F.col("post_url")),
                "primary_text": F.col("text"),
                "full_text_context": F.concat("thread", F.lit(" "), "own_context"),
            }
        ),
        platform,
    )


def _items(df: DataFrame, platform: Platform) -> DataFrame:
    """The 18 columns of the item table."""
    none = F.array().cast("array<string>")
    return df.select(
        F.lit(platform.source).alias("source"),
        "content_type",
        "content_item_id",
        "parent_content_item_id",
        F.col("post_id").alias("top_level_post_id"),
        F.col("url").alias("content_item_url"),
        F.col("author").alias("author_username"),
        "primary_text",
        "full_text_context",
        F.col("upvotes").alias("engagement_score"),
        F.col("at").alias("content_timestamp"),
        F.col("community").alias("community_or_channel_name"),
        none.alias("hashtags"),
        none.alias("mentions"),
        "media_urls",
        "video_urls",
        "record_load_timestamp",
        "snapshot_id",
    )


def platform_items(raw: DataFrame, platform: Platform, reply_id_includes_text: bool = False) -> DataFrame:
    """All newest items of one platform.

    Versions are reduced before the levels are joined: the newest of a join equals the join of the newest, as an
    item's id fixes its parent, and joining versions with versions would grow with their product.
    """
    posts = posts_base(raw, platform)
    replies = replies_base(comments_base(posts, platform), platform, reply_id_includes_text)
    # The projection and the context of the children read the same newest posts: ranked once, with all columns, and written.
    best_posts = cut(latest_posts(posts))
    best_comments = latest_comments(comments_base(posts, platform, with_replies=False))
    children = _comment_rows(best_comments).unionByName(_reply_rows(latest_replies(replies)))
    return project_posts(best_posts, platform).unionByName(_project_children(children, best_posts, platform))


def unified_items(reddit: DataFrame, quora: DataFrame | None = None, reply_id_includes_text: bool = False) -> DataFrame:
    """The item table: newest posts, comments and replies of both platforms."""
    items = platform_items(reddit, REDDIT, reply_id_includes_text)
    if quora is not None:
        items = items.unionByName(platform_items(quora, QUORA, reply_id_includes_text))
    return items


def orphans(items: DataFrame) -> DataFrame:
    """Items whose parent is not in the table.

    The items are written once, as their view is costly. Children are counted per parent before ids are compared, and a
    missing parent with very many children is split when these are picked.
    """
    items = cut(items)
    children = items.filter(F.col("parent_content_item_id").isNotNull())
    parents = children.groupBy("parent_content_item_id").agg(F.count(F.lit(1)).alias("n_children"))
    ids = items.select(F.col("content_item_id").alias("parent_content_item_id")).distinct()
    missing = parents.join(ids, "parent_content_item_id", "left_anti").select("parent_content_item_id")
    return skew_join(children, missing, "parent_content_item_id").select(*items.columns)
