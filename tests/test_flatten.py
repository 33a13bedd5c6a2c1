import datetime as dt
import hashlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import final_plan, rows
from threadloom import fixtures as fx
from threadloom.operators import flatten as fl
from threadloom.schemas import QUORA_DATA, REDDIT_DATA, UNIFIED_ITEMS, fields

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def post(post_id="p1", title="t", description="d", comments=(), posted=T0, loaded=T0, snapshot_id="s1", **more):
    base = {f.name: None for f in fields(REDDIT_DATA)}
    return {
        **base, "post_id": post_id, "title": title, "description": description, "comments": list(comments),
        "date_posted": posted, "timestamp": loaded, "snapshot_id": snapshot_id, "url": f"u/{post_id}", **more,
    }


def comment(text="c", author="a", at=T0, replies=(), votes=1, url="cu"):
    return {
        "replies": list(replies), "num_replies": None, "user_commenting": author, "num_upvotes": votes,
        "date_of_comment": at, "url": url, "user_url": None, "comment": text,
    }


def reply(text="r", author="b", at=T0, votes=1):
    return {"num_replies": None, "num_upvotes": votes, "date_of_reply": at, "user_url": "ru", "reply": text, "user_replying": author}


def reddit(spark, *posts):
    return spark.createDataFrame(list(posts), fields(REDDIT_DATA))


def items(spark, *posts, **options):
    return fl.unified_items(reddit(spark, *posts), **options)


def found(df, kind):
    return df.filter(F.col("content_type") == kind)


def test_item_schema(spark):
    assert [(f.name, f.dataType) for f in items(spark, post()).schema] == [(f.name, f.dataType) for f in fields(UNIFIED_ITEMS)]


def test_posts_need_an_id_and_some_text(spark):
    df = items(spark, post(), post("p2", title=None), post("p3", title=None, description=None), post(None))
    assert rows(df, "content_item_id", "primary_text", "full_text_context") == [("p1", "t", "d"), ("p2", None, "d")]


def test_a_dropped_parent_drops_its_subtree(spark):
    df = items(
        spark, post("p1", comments=[comment(None, replies=[reply()]), comment("kept")]),
        post("p2", title=None, description=None, comments=[comment("lost", replies=[reply()])]),
    )
    assert rows(df, "content_type", "primary_text") == [("comment", "kept"), ("post", "t")]


def test_null_lists_and_null_elements(spark):
    df = items(spark, post("p1", comments=[None, comment("c", replies=[None])]), {**post("p2"), "comments": None})
    assert rows(df.groupBy("content_type").count()) == [("comment", 1), ("post", 2)]


def test_comment_id(spark):
    df = found(items(spark, post(comments=[comment("hi", "me", dt.datetime(2024, 2, 3, 4, 5, 6, 999))])), "comment")
    digest = hashlib.md5(b"p1me202402030405062024-02-03hi").hexdigest()
    assert rows(df, "content_item_id") == [(f"reddit_comment_gen_{digest}",)]


def test_missing_parts_of_an_id_are_blank_and_epoch(spark):
    df = found(items(spark, post(comments=[comment("hi", None, None)])), "comment")
    digest = hashlib.md5(b"p1197001010000001970-01-01hi").hexdigest()
    assert rows(df, "content_item_id") == [(f"reddit_comment_gen_{digest}",)]


def test_replies_of_one_author_in_one_second_share_an_id_unless_the_text_counts(spark):
    thread = post(comments=[comment(replies=[reply("one"), reply("two")])])
    assert found(items(spark, thread), "reply").count() == 1
    assert found(items(spark, thread, reply_id_includes_text=True), "reply").count() == 2


def test_quora_reply_ids_hash_the_text(spark):
    answers = [{"commenter_name": "c", "comment": "x", "comment_date": T0,
                "replys": [{"commenter_name": "r", "comment": t, "comment_date": T0} for t in ("one", "two")]}]
    base = {f.name: None for f in fields(QUORA_DATA)}
    raw = spark.createDataFrame(
        [{**base, "post_id": "q1", "title": "t", "top_comments": answers, "videos_urls": "v", "url": "qu", "snapshot_id": "s"}],
        fields(QUORA_DATA),
    )
    df = fl.platform_items(raw, fl.QUORA)
    assert found(df, "reply").count() == 2
    assert rows(df.select("content_item_url", "engagement_score").distinct()) == [("qu", None)]
    assert rows(found(df, "post").select("media_urls", "video_urls")) == [([], ["v"])]


def test_newest_version_wins_with_settled_ties(spark):
    later = T0 + dt.timedelta(days=1)
    versions = [
        post(posted=T0, loaded=later, title="old"), post(posted=later, loaded=T0, title="new", snapshot_id="s1"),
        post(posted=later, loaded=later, title="newest", snapshot_id="s1"),
        post(posted=later, loaded=later, title="a tie", snapshot_id="s2"), post(posted=later, loaded=later, title="b tie", snapshot_id="s2"),
        post(posted=None, loaded=later, title="undated", snapshot_id="s9"),
    ]
    for order in (versions, versions[::-1]):
        assert rows(items(spark, *order), "primary_text", "snapshot_id") == [("a tie", "s2")]


def test_context_comes_from_the_newest_post_that_may_lack_the_comment(spark):
    later = T0 + dt.timedelta(days=1)
    df = items(
        spark, post(comments=[comment(replies=[reply()])], title="old"),
        post(posted=later, loaded=later, title="new", description=None, snapshot_id="s2", community_name="x"),
    )
    assert rows(df, "content_type", "full_text_context", "snapshot_id", "community_or_channel_name") == [
        ("comment", "new  c", "s2", "x"), ("post", None, "s2", "x"), ("reply", "new  c r", "s2", "x"),
    ]


def literal_items(raw, platform):
    """The definition taken literally: join all versions, then rank the joined rows."""
    posts = fl.posts_base(raw, platform)
    comments = fl.comments_base(posts, platform)
    replies = fl.replies_base(comments, platform)

    def newest(df, key, *sides):
        order = []
        for side in sides:
            order += [F.col(f"{side}.at").desc_nulls_last(), F.col(f"{side}.record_load_timestamp").desc_nulls_last(),
                      F.col(f"{side}.snapshot_id").desc_nulls_last()]
        rn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        return df.withColumn("rn", rn).filter("rn = 1")

    blank = F.lit("")
    head = F.concat(F.coalesce("p.title", blank), F.lit(" "), F.coalesce("p.body", blank), F.lit(" "))
    p, c, r = posts.alias("p"), comments.alias("c"), replies.alias("r")
    c_rows = newest(c.join(p, F.col("c.post_id") == F.col("p.post_id")), F.col("c.comment_id"), "c", "p").select(
        F.col("c.comment_id").alias("id"), F.concat(head, F.col("c.text")).alias("context"), F.col("p.snapshot_id").alias("snapshot"),
        F.col("c.upvotes").alias("votes"),
    )
    joined = r.join(c, F.col("r.comment_id") == F.col("c.comment_id")).join(p, F.col("r.post_id") == F.col("p.post_id"))
    r_rows = newest(joined, F.col("r.reply_id"), "r", "c", "p").select(
        F.col("r.reply_id").alias("id"), F.concat(head, F.col("c.text"), F.lit(" "), F.col("r.text")).alias("context"),
        F.col("p.snapshot_id").alias("snapshot"), F.col("r.upvotes").alias("votes"),
    )
    return c_rows.unionByName(r_rows)


@pytest.mark.parametrize("platform", [fl.REDDIT, fl.QUORA], ids=lambda p: p.source)
def test_reducing_before_joining_equals_joining_before_reducing(spark, sf, platform):
    raw = fx.reddit_data(spark, sf) if platform is fl.REDDIT else fx.quora_data(spark, sf)
    ours = fl.platform_items(raw, platform).filter("content_type <> 'post'")
    assert rows(ours, "content_item_id", "full_text_context", "snapshot_id", "engagement_score") == rows(
        literal_items(raw, platform), "id", "context", "snapshot", "votes"
    )


def test_long_threads_come_in_records_of_bounded_size(spark, sf, tmp_path):
    turns = spark.range(400).select(
        F.lit(2).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("text "), "id").alias("text"),
    )
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    raw = fx.build_reddit_data(spark, str(tmp_path))
    assert raw.agg(F.max(F.size("comments")), F.count(F.lit(1))).first() == (fx.PAIRS_PER_RECORD, 4)
    kept = sum(1 for t in range(1, 400, 2) if (2 + t) % 13)
    kinds = dict(tuple(r) for r in fl.unified_items(raw).groupBy("content_type").count().collect())
    assert kinds == {"post": 1, "comment": kept, "reply": sum(1 for t in range(2, 400, 2) if (1 + t) % 13)}


def test_partitioning_does_not_change_the_result(spark, sf):
    raw = fx.reddit_data(spark, sf)
    cols = ["content_item_id", "full_text_context", "snapshot_id", "engagement_score"]
    assert rows(fl.unified_items(raw.repartition(13)), *cols) == rows(fl.unified_items(raw.coalesce(1)), *cols)


def test_versions_are_reduced_before_the_shuffle(spark, sf):
    best = fl.latest_posts(fl.posts_base(fx.reddit_data(spark, sf), fl.REDDIT))
    plan = final_plan(best)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_comment_pass_does_not_read_replies(spark, sf):
    posts = fl.posts_base(fx.reddit_data(spark, sf), fl.REDDIT)
    best = fl.latest_comments(fl.comments_base(posts, fl.REDDIT, with_replies=False))
    scan = best._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
    assert "replies" not in scan and "title" in scan


def test_no_python_in_the_item_plan(spark, sf):
    plan = final_plan(fl.unified_items(fx.reddit_data(spark, sf), fx.quora_data(spark, sf)))
    assert "Python" not in plan and "InPandas" not in plan


def test_a_post_with_a_third_of_all_comments_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        raw = spark.range(0, 3000, 1, 16).selectExpr(
            "if(id % 3 = 0, 'hot', concat('p', id)) post_id", "'u' url", "'a' user_posted", "'t' title", "'d' description",
            "1L num_upvotes", "timestamp'2024-01-01' date_posted", "'c' community_name", "array('x') photos", "array('y') videos",
            "timestamp_seconds(id) timestamp", "'s' snapshot_id",
            """transform(sequence(1, 10), i -> named_struct('replies', array(named_struct('num_upvotes', 1L, 'date_of_reply',
               timestamp'2024-01-01', 'user_url', 'u', 'reply', 'r', 'user_replying', 'me')), 'user_commenting', 'u',
               'num_upvotes', 2L, 'date_of_comment', timestamp'2024-01-01', 'url', 'z', 'comment', concat('text ', id, ' ', i))) comments""",
        )
        df = fl.unified_items(raw)
        assert "SortMergeJoin(skew=true)" in final_plan(df)
        assert df.count() == 2001 + 2 * 30000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_orphans(spark):
    df = items(spark, post(comments=[comment()])).filter("content_type <> 'post'")
    assert rows(fl.orphans(df), "content_type") == [("comment",)]
