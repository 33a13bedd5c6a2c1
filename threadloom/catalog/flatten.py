"""Queries over the flattened threads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import fixtures as fx
from threadloom.operators import flatten as fl
from threadloom.operators.skew import spread_join

# The same items, straight from the conversations table.
THREADS = """
said AS (
  SELECT conv_id, turn, role, text,
         TIMESTAMP '2024-01-01' + to_seconds(conv_id % 10000 * 3600 + turn * 60) AS tm,
         CASE WHEN conv_id % 9 = 0 THEN 2 WHEN conv_id % 3 = 0 THEN 1 ELSE 0 END AS snap
  FROM conversations),
stamped AS (
  SELECT *, strftime(tm, '%Y%m%d%H%M%S%Y-%m-%d') AS idt,
         (conv_id * 7 + turn * 3 + snap) % 100 AS votes,
         TIMESTAMP '2024-03-01' + to_days(snap) AS loaded
  FROM said),
r_posts AS (
  SELECT *, 'p' || conv_id AS post_id, CASE WHEN conv_id % 11 <> 0 THEN text END AS title,
         CASE WHEN conv_id % 2 = 0 THEN 'body of ' || conv_id END AS body
  FROM stamped WHERE turn = 0 AND (conv_id % 11 <> 0 OR conv_id % 2 = 0)),
r_comments AS (
  SELECT s.*, p.post_id, p.title, p.body, 'reddit_comment_gen_' || md5(p.post_id || s.role || s.idt || s.text) AS comment_id
  FROM stamped s JOIN r_posts p USING (conv_id) WHERE s.turn % 2 = 1 AND (s.conv_id + s.turn) % 13 <> 0),
r_replies AS (
  SELECT s.*, c.post_id, c.comment_id, c.title, c.body, c.text AS comment,
         'reddit_reply_gen_' || md5(c.comment_id || s.role || s.idt || s.role) AS reply_id
  FROM stamped s JOIN r_comments c ON s.conv_id = c.conv_id AND s.turn = c.turn + 1),
q_posts AS (
  SELECT *, 'q' || conv_id AS post_id, CASE WHEN conv_id % 3 = 0 THEN 'details of ' || conv_id END AS body,
         'q_' || role AS author
  FROM stamped WHERE turn = 0),
q_comments AS (
  SELECT s.*, p.post_id, p.text AS title, p.body, 'q_' || s.role AS author,
         'quora_comment_gen_' || md5(p.post_id || 'q_' || s.role || s.idt || s.text) AS comment_id
  FROM stamped s JOIN q_posts p USING (conv_id) WHERE s.turn % 2 = 1),
q_replies AS (
  SELECT s.*, c.post_id, c.comment_id, c.title, c.body, c.text AS comment, 'q_' || s.role AS author,
         'quora_reply_gen_' || md5(c.comment_id || 'q_' || s.role || s.idt || s.text) AS reply_id
  FROM stamped s JOIN q_comments c ON s.conv_id = c.conv_id AND s.turn = c.turn + 1)
"""

ITEMS = THREADS + """,
items AS (
  SELECT 'Reddit' AS source, 'post' AS content_type, post_id AS content_item_id, CAST(NULL AS VARCHAR) AS parent_content_item_id,
         post_id AS top_level_post_id, 'https://r.example/p' || conv_id AS content_item_url, role AS author_username,
         title AS primary_text, body AS full_text_context, votes AS engagement_score, tm AS content_timestamp,
         'c' || conv_id % 7 AS community_or_channel_name,
         CASE WHEN conv_id % 3 = 0 THEN 'https://img.example/' || conv_id ELSE '' END AS media_urls,
         '' AS video_urls, loaded AS record_load_timestamp, 's_' || snap AS snapshot_id
  FROM r_posts
  UNION ALL
  SELECT 'Reddit', 'comment', comment_id, post_id, post_id, 'https://r.example/p' || conv_id || '/' || turn, role, text,
         coalesce(title, '') || ' ' || coalesce(body, '') || ' ' || text, votes, tm, 'c' || conv_id % 7, '', '', loaded, 's_' || snap
  FROM r_comments
  UNION ALL
  SELECT 'Reddit', 'reply', reply_id, comment_id, post_id, 'https://r.example/u/' || role, role, text,
         coalesce(title, '') || ' ' || coalesce(body, '') || ' ' || comment || ' ' || text, votes, tm, 'c' || conv_id % 7, '', '', loaded, 's_' || snap
  FROM r_replies
  UNION ALL
  SELECT 'Quora', 'post', post_id, NULL, post_id, 'https://q.example/' || conv_id, author, text, body, votes, tm, NULL,
         CASE WHEN conv_id % 3 = 0 THEN 'https://img.example/' || conv_id ELSE '' END,
         CASE WHEN conv_id % 4 = 1 THEN 'https://vid.example/' || conv_id ELSE '' END, loaded, 's_' || snap
  FROM q_posts
  UNION ALL
  SELECT 'Quora', 'comment', comment_id, post_id, post_id, 'https://q.example/' || conv_id, author, text,
         coalesce(title, '') || ' ' || coalesce(body, '') || ' ' || text, NULL, tm, NULL, '', '', loaded, 's_' || snap
  FROM q_comments
  UNION ALL
  SELECT 'Quora', 'reply', reply_id, comment_id, post_id, 'https://q.example/' || conv_id, author, text,
         coalesce(title, '') || ' ' || coalesce(body, '') || ' ' || comment || ' ' || text, NULL, tm, NULL, '', '', loaded, 's_' || snap
  FROM q_replies)
"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.unified_items(fx.reddit_data(spark, sf_dir), fx.quora_data(spark, sf_dir))


def unified_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = items(spark, sf_dir).withColumns(
        {c: F.array_join(c, ",") for c in ("hashtags", "mentions", "media_urls", "video_urls")}
    )
    return plain.withColumns({c: fx.text_time(c) for c in ("content_timestamp", "record_load_timestamp")})


def unified_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).groupBy("source", "content_type").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.countDistinct("content_item_id").alias("n_ids"),
        F.sum("engagement_score").alias("engagement"),
        F.sum(F.length("full_text_context")).alias("context_chars"),
    )


def _versions(base: DataFrame, key: str, text: str) -> DataFrame:
    return base.select(
        key, "post_id", "author", F.col(text).alias("text"), fx.text_time("at"), "upvotes",
        fx.text_time("record_load_timestamp"), "snapshot_id",
    )


def _base(platform: fl.Platform, level: str):
    raw = fx.reddit_data if platform is fl.REDDIT else fx.quora_data

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        posts = fl.posts_base(raw(spark, sf_dir), platform)
        if level == "post":
            # A thread of several records repeats its post once per record.
            return posts.select(
                "post_id", "url", "author", "title", "body", "upvotes", fx.text_time("at"), "community",
                F.array_join("media_urls", ",").alias("media_urls"), F.array_join("video_urls", ",").alias("video_urls"),
                fx.text_time("record_load_timestamp"), "snapshot_id",
            ).distinct()
        comments = fl.comments_base(posts, platform)
        if level == "comment":
            return _versions(comments, "comment_id", "text")
        return _versions(fl.replies_base(comments, platform), "reply_id", "text")

    return run


_SNAPS = "(VALUES (0), (1), (2)) v(k)"


def _versions_sql(table: str, key: str, author: str, votes: str, text: str = "text") -> str:
    return f"""WITH {THREADS}
    SELECT {key}, post_id, {author} AS author, {text} AS text, strftime(tm, '%Y-%m-%d %H:%M:%S') AS "at", {votes} AS upvotes,
           strftime(TIMESTAMP '2024-03-01' + to_days(k), '%Y-%m-%d %H:%M:%S') AS record_load_timestamp, 's_' || k AS snapshot_id
    FROM {table} JOIN {_SNAPS} ON k <= snap"""


def _posts_sql(table: str, host: str, author: str, title: str, community: str, videos: str) -> str:
    return f"""WITH {THREADS}
    SELECT post_id, '{host}' || conv_id AS url, {author} AS author, {title} AS title, body,
           (conv_id * 7 + k) % 100 AS upvotes, strftime(tm, '%Y-%m-%d %H:%M:%S') AS "at", {community} AS community,
           CASE WHEN conv_id % 3 = 0 THEN 'https://img.example/' || conv_id ELSE '' END AS media_urls, {videos} AS video_urls,
           strftime(TIMESTAMP '2024-03-01' + to_days(k), '%Y-%m-%d %H:%M:%S') AS record_load_timestamp, 's_' || k AS snapshot_id
    FROM {table} JOIN {_SNAPS} ON k <= snap"""


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many ids each branch makes, and an order-free digest of them."""
    return items(spark, sf_dir).groupBy("source", "content_type", F.substring("content_item_id", -2, 2).alias("tail")).agg(
        F.count(F.lit(1)).alias("n_ids"), F.min("content_item_id").alias("first_id"), F.max("content_item_id").alias("last_id")
    )


def reply_ids_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    reddit = fl.platform_items(fx.reddit_data(spark, sf_dir), fl.REDDIT, reply_id_includes_text=True)
    return reddit.filter("content_type = 'reply'").select("content_item_id", "parent_content_item_id", "primary_text")


def latest_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = fl.latest_posts(fl.posts_base(fx.reddit_data(spark, sf_dir), fl.REDDIT))
    return best.select("post_id", "snapshot_id", "upvotes", fx.text_time("record_load_timestamp"))


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user: the dedup operator on a table with a few busy keys."""
    from threadloom.operators.latest import latest_by

    newest = latest_by(fx.table(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return newest.select("user_id", "event_id", "event_type", "value")


def media_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = items(spark, sf_dir).filter("content_type = 'post'")
    return posts.groupBy("source", F.size("media_urls").cast("bigint").alias("n_media"), F.size("video_urls").cast("bigint").alias("n_videos")).agg(
        F.count(F.lit(1)).alias("n_posts")
    )


def thread_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).groupBy("top_level_post_id", "source").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count("parent_content_item_id").alias("n_children"),
        F.countDistinct("parent_content_item_id").alias("n_parents"),
    )


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children without their parent, once posts without a title are taken out."""
    kept = items(spark, sf_dir).filter("primary_text is not null")
    return fl.orphans(kept).groupBy("source", "content_type").agg(F.count(F.lit(1)).alias("n_orphans"))


def salted_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with the opening of its conversation, joined with each conversation treated as hot."""
    turns = fx.table(spark, sf_dir, "conversations").withColumn("row", F.concat_ws(":", "conv_id", "turn"))
    openings = turns.filter("turn = 0").select("conv_id", F.col("text").alias("opening"))
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    joined = spread_join(turns, openings, "conv_id", "row", counts, floor=1)
    return joined.select("conv_id", "turn", F.md5("opening").alias("opening_md5"), F.length("text").cast("bigint").alias("chars"))


QUERIES = {
    "reddit_posts_base": _base(fl.REDDIT, "post"),
    "reddit_comments_base": _base(fl.REDDIT, "comment"),
    "reddit_replies_base": _base(fl.REDDIT, "reply"),
    "quora_questions_base": _base(fl.QUORA, "post"),
    "quora_comments_base": _base(fl.QUORA, "comment"),
    "quora_replies_base": _base(fl.QUORA, "reply"),
    "stable_ids": stable_ids,
    "reply_ids_with_text": reply_ids_with_text,
    "latest_posts": latest_posts,
    "latest_events": latest_events,
    "unified_items": unified_items,
    "unified_counts": unified_counts,
    "media_lists": media_lists,
    "thread_lineage": thread_lineage,
    "orphans": orphans,
    "salted_context": salted_context,
}

SQL = {
    "reddit_posts_base": _posts_sql("r_posts", "https://r.example/p", "role", "title", "'c' || conv_id % 7", "''"),
    "reddit_comments_base": _versions_sql("r_comments", "comment_id", "role", "(conv_id * 7 + turn * 3 + k) % 100"),
    "reddit_replies_base": _versions_sql("r_replies", "reply_id", "role", "(conv_id * 7 + turn * 3 + k) % 100"),
    "quora_questions_base": _posts_sql(
        "q_posts", "https://q.example/", "author", "text", "CAST(NULL AS VARCHAR)",
        "CASE WHEN conv_id % 4 = 1 THEN 'https://vid.example/' || conv_id ELSE '' END",
    ),
    "quora_comments_base": _versions_sql("q_comments", "comment_id", "author", "CAST(NULL AS BIGINT)"),
    "quora_replies_base": _versions_sql("q_replies", "reply_id", "author", "CAST(NULL AS BIGINT)"),
    "stable_ids": f"""WITH {ITEMS}
    SELECT source, content_type, right(content_item_id, 2) AS tail, count(*) AS n_ids,
           min(content_item_id) AS first_id, max(content_item_id) AS last_id FROM items GROUP BY ALL""",
    "reply_ids_with_text": f"""WITH {THREADS}
    SELECT 'reddit_reply_gen_' || md5(comment_id || role || idt || text) AS content_item_id,
           comment_id AS parent_content_item_id, text AS primary_text FROM r_replies""",
    "latest_posts": f"""WITH {THREADS}
    SELECT post_id, 's_' || snap AS snapshot_id, votes AS upvotes,
           strftime(loaded, '%Y-%m-%d %H:%M:%S') AS record_load_timestamp FROM r_posts""",
    "latest_events": """SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "unified_items": f"""WITH {ITEMS}
    SELECT * REPLACE (strftime(content_timestamp, '%Y-%m-%d %H:%M:%S') AS content_timestamp,
                      strftime(record_load_timestamp, '%Y-%m-%d %H:%M:%S') AS record_load_timestamp),
           '' AS hashtags, '' AS mentions FROM items""",
    "unified_counts": f"""WITH {ITEMS}
    SELECT source, content_type, count(*) AS n_items, count(DISTINCT content_item_id) AS n_ids,
           CAST(sum(engagement_score) AS BIGINT) AS engagement, CAST(sum(length(full_text_context)) AS BIGINT) AS context_chars
    FROM items GROUP BY 1, 2""",
    "media_lists": f"""WITH {ITEMS}
    SELECT source, CASE WHEN media_urls = '' THEN 0 ELSE 1 END AS n_media,
           CASE WHEN video_urls = '' THEN 0 ELSE 1 END AS n_videos, count(*) AS n_posts
    FROM items WHERE content_type = 'post' GROUP BY 1, 2, 3""",
    "thread_lineage": f"""WITH {ITEMS}
    SELECT top_level_post_id, source, count(*) AS n_items, count(parent_content_item_id) AS n_children,
           count(DISTINCT parent_content_item_id) AS n_parents FROM items GROUP BY 1, 2""",
    "orphans": f"""WITH {ITEMS}, kept AS (SELECT * FROM items WHERE primary_text IS NOT NULL)
    SELECT source, content_type, count(*) AS n_orphans FROM kept k
    WHERE parent_content_item_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM kept p WHERE p.content_item_id = k.parent_content_item_id) GROUP BY 1, 2""",
    "salted_context": """SELECT c.conv_id, c.turn, md5(o.text) AS opening_md5, length(c.text) AS chars
    FROM conversations c JOIN conversations o ON o.conv_id = c.conv_id AND o.turn = 0""",
}
