"""The given tables in the shapes the operators read.

Raw threads are derived from ``conversations``: turn 0 is the post, odd turns are comments, an even turn replies
to the comment before it. A thread with a third of all turns would make one giant record, so a record holds at
most ``PAIRS_PER_RECORD`` comments, as scraped pages do; flattening unites the records of a post.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import run_dir

PAIRS_PER_RECORD = 64
BASE_EPOCH = 1704067200  # 2024-01-01 UTC
LOAD_EPOCH = 1709251200  # 2024-03-01 UTC
DAY = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with zone-less times read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    fixes = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(fixes) if fixes else df


_STAGED: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """``build``'s result as a table written once per application to the shared folder.

    The raw tables are stored tables in real use, so queries start from a scan of one.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    if key not in _STAGED:
        path = run_dir(spark, name)
        build(spark, sf_dir).write.parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def said_at(conv: Column, turn: Column) -> Column:
    return F.timestamp_seconds(F.lit(BASE_EPOCH) + conv % 10000 * 3600 + turn * 60)


def loaded_at(snap: Column) -> Column:
    return F.timestamp_seconds(F.lit(LOAD_EPOCH) + snap * DAY)


def _threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, snap, role and text of the post, pairs: array<struct<turn, role, text, r: struct<turn, role, text>>>."""
    turns = table(spark, sf_dir, "conversations")
    said = F.struct("turn", "role", "text")
    pairs = (
        turns.filter("turn > 0")
        .groupBy("conv_id", F.floor((F.col("turn") - 1) / 2).alias("pair"))
        .agg(F.max(F.when(F.col("turn") % 2 == 1, said)).alias("c"), F.max(F.when(F.col("turn") % 2 == 0, said)).alias("r"))
        .filter("c is not null")
    )
    records = pairs.groupBy("conv_id", F.floor(F.col("pair") / PAIRS_PER_RECORD).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("c.turn", "c.role", "c.text", "r"))).alias("pairs")
    )
    posts = turns.filter("turn = 0").select("conv_id", "role", "text")
    snaps = F.when(F.col("conv_id") % 9 == 0, F.sequence(F.lit(0), F.lit(2))).when(
        F.col("conv_id") % 3 == 0, F.sequence(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    empty = F.array().cast(records.schema["pairs"].dataType)
    return (
        posts.join(records, "conv_id", "left")
        .withColumn("pairs", F.coalesce("pairs", empty))
        .withColumn("snap", F.explode(snaps))
        .withColumn("page", F.coalesce("page", F.lit(0)))
    )


def _votes(conv: Column, turn: Column, snap: Column) -> Column:
    return (conv * 7 + turn * 3 + snap) % 100


def reddit_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "reddit_data", build_reddit_data)


def quora_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "quora_data", build_quora_data)


def build_reddit_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reddit records in 1 to 3 snapshots. Some posts lack a title, some of those a body too; some comments are null."""
    conv, snap = F.col("conv_id"), F.col("snap")

    def comment(c: Column) -> Column:
        def reply(r: Column) -> Column:
            return F.struct(
                _votes(conv, r["turn"], snap).alias("num_upvotes"),
                said_at(conv, r["turn"]).alias("date_of_reply"),
                F.concat(F.lit("https://r.example/u/"), r["role"]).alias("user_url"),
                r["text"].alias("reply"),
                r["role"].alias("user_replying"),
            )

        return F.struct(
            F.filter(F.array(F.when(c["r"].isNotNull(), reply(c["r"]))), lambda r: r.isNotNull()).alias("replies"),
            c["role"].alias("user_commenting"),
            _votes(conv, c["turn"], snap).alias("num_upvotes"),
            said_at(conv, c["turn"]).alias("date_of_comment"),
            F.concat(F.lit("https://r.example/p"), conv, F.lit("/"), c["turn"]).alias("url"),
            F.when((conv + c["turn"]) % 13 != 0, c["text"]).alias("comment"),
        )

    return _threads(spark, sf_dir).select(
        F.concat(F.lit("p"), conv).alias("post_id"),
        F.concat(F.lit("https://r.example/p"), conv).alias("url"),
        F.col("role").alias("user_posted"),
        F.when(conv % 11 != 0, F.col("text")).alias("title"),
        F.when(conv % 2 == 0, F.concat(F.lit("body of "), conv)).alias("description"),
        _votes(conv, F.lit(0), snap).alias("num_upvotes"),
        said_at(conv, F.lit(0)).alias("date_posted"),
        F.concat(F.lit("c"), conv % 7).alias("community_name"),
        F.when(conv % 3 == 0, F.array(F.concat(F.lit("https://img.example/"), conv)))
        .otherwise(F.array().cast("array<string>")).alias("photos"),
        F.array().cast("array<string>").alias("videos"),
        loaded_at(snap).alias("timestamp"),
        F.transform("pairs", comment).alias("comments"),
        F.concat(F.lit("s_"), snap).alias("snapshot_id"),
        "page",
    )


def build_quora_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quora records of all conversations, roles marked, without votes below the question."""
    conv, snap = F.col("conv_id"), F.col("snap")

    def author(role: Column) -> Column:
        return F.concat(F.lit("q_"), role)

    def comment(c: Column) -> Column:
        def reply(r: Column) -> Column:
            return F.struct(
                author(r["role"]).alias("commenter_name"),
                r["text"].alias("comment"),
                said_at(conv, r["turn"]).alias("comment_date"),
            )

        return F.struct(
            author(c["role"]).alias("commenter_name"),
            c["text"].alias("comment"),
            said_at(conv, c["turn"]).alias("comment_date"),
            F.filter(F.array(F.when(c["r"].isNotNull(), reply(c["r"]))), lambda r: r.isNotNull()).alias("replys"),
        )

    return _threads(spark, sf_dir).select(
        F.concat(F.lit("q"), conv).alias("post_id"),
        F.concat(F.lit("https://q.example/"), conv).alias("url"),
        author(F.col("role")).alias("author_name"),
        F.col("text").alias("title"),
        F.when(conv % 3 == 0, F.concat(F.lit("details of "), conv)).alias("post_text"),
        _votes(conv, F.lit(0), snap).alias("upvotes"),
        said_at(conv, F.lit(0)).alias("post_date"),
        F.when(conv % 3 == 0, F.array(F.concat(F.lit("https://img.example/"), conv))).alias("pictures_urls"),
        F.when(conv % 4 == 1, F.concat(F.lit("https://vid.example/"), conv)).alias("videos_urls"),
        F.transform("pairs", comment).alias("top_comments"),
        loaded_at(snap).alias("timestamp"),
        F.concat(F.lit("s_"), snap).alias("snapshot_id"),
    )


def build_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given file dealt over as many files as there are cores, as a stored table has many."""
    return table(spark, sf_dir, "documents").repartition(spark.sparkContext.defaultParallelism)


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as items: load times spread over the five days before 2024-03-01.

    A table that Spark reads in as many parts as there are cores is read where it is, and not copied.
    """
    doc, given = F.col("doc_id"), table(spark, sf_dir, "documents")
    if given.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        given = staged(spark, sf_dir, "documents", build_documents)
    return given.select(
        F.col("source"),
        F.lit("post").alias("content_type"),
        doc.cast("string").alias("content_item_id"),
        F.col("text").alias("primary_text"),
        F.concat_ws(" ", "lang", "text").alias("full_text_context"),
        F.timestamp_seconds(F.lit(BASE_EPOCH) + doc % 10000 * 3600).alias("content_timestamp"),
        F.timestamp_seconds(F.lit(LOAD_EPOCH) - doc % 5 * DAY).alias("record_load_timestamp"),
        F.lit(None).cast("string").alias("parent_content_item_id"),
        doc.cast("string").alias("top_level_post_id"),
        F.col("lang"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as (unified_id, embeddings, label)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("unified_id"),
        F.col("embedding").cast("array<double>").alias("embeddings"),
        "label",
    )


def text_time(col: str) -> Column:
    """A time as text, so results compare the same wherever they are read."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def reddit_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, snap, page, post): the Reddit records as JSON text, with the irregularities scrapes have."""
    conv = F.col("conv_id")
    votes = F.col("num_upvotes").cast("string")
    iso = "yyyy-MM-dd'T'HH:mm:ss"

    def reply(r: Column) -> Column:
        return F.struct(
            r["num_upvotes"].cast("string").alias("num_upvotes"),
            F.date_format(r["date_of_reply"], iso + "'Z'").alias("date_of_reply"),
            r["user_url"].alias("user_url"), r["reply"].alias("reply"), r["user_replying"].alias("user_replying"),
        )

    def comment(c: Column) -> Column:
        return F.struct(
            F.transform(c["replies"], reply).alias("replies"),
            c["num_upvotes"].alias("num_upvotes"),
            F.date_format(c["date_of_comment"], iso + "'Z'").alias("date_of_comment"),
            c["url"].alias("url"), c["user_commenting"].alias("user_commenting"), c["comment"].alias("comment"),
        )

    def pick(divisor: int, *choices: Column) -> Column:
        expr = F.when(conv % divisor == 0, choices[0])
        for i, choice in enumerate(choices[1:], 1):
            expr = expr.when(conv % divisor == i, choice)
        return expr

    number = F.parse_json(pick(
        6, votes, F.concat(F.lit('"'), votes, F.lit('"')), F.concat(F.lit('" '), votes, F.lit(' "')), F.lit('"n/a"'),
        F.concat(votes, F.lit(".7")), F.lit('""'),
    ))
    posted = pick(
        5, F.date_format("date_posted", iso + "'.000Z'"), F.date_format("date_posted", iso + "'+02:00'"), F.lit("2024"),
        F.date_format("date_posted", "yyyy-MM-dd"), F.lit("soon"),
    )
    photos = F.parse_json(pick(4, F.lit('["a", "b"]'), F.lit('"a"'), F.lit("null"), F.lit("[]")))
    rank = F.parse_json(pick(3, F.lit('{"community_rank_value": "1", "community_rank_type": "top"}'), F.lit("{}"), F.lit("null")))
    record = F.struct(
        "post_id", "url", "user_posted", "title", "description", number.alias("num_upvotes"), posted.alias("date_posted"),
        "community_name", photos.alias("photos"), rank.alias("community_rank"),
        F.transform("comments", comment).alias("comments"),
        F.date_format("timestamp", iso + "'Z'").alias("timestamp"),
    )
    return (
        reddit_data(spark, sf_dir)
        .withColumn("conv_id", F.substring("post_id", 2, 20).cast("bigint"))
        .select("conv_id", F.col("snapshot_id").alias("snap"), "page", F.to_json(record).alias("post"))
    )


def search_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(search_query, pagination_start, response): ten pages per response; every fifth one lists no results."""
    page = F.col("page_id")
    fields = [
        F.col("url").alias("link"), F.concat(F.lit("page "), page).alias("title"),
        F.when(page % 3 == 2, F.concat(F.lit("about "), page)).alias("description"),
        (page % 10 + 1).alias("rank"), (page + 1).alias("global_rank"),
    ]
    # A null field is left out of the text, or written as null.
    entry = F.when(page % 3 == 1, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})).otherwise(
        F.to_json(F.struct(*fields))
    )
    request = F.floor(page / 10).cast("bigint")
    grouped = table(spark, sf_dir, "pages").groupBy(request.alias("n")).agg(
        F.array_sort(F.collect_list(F.struct(page, entry.alias("entry")))).alias("rows")
    )
    head = F.concat(
        F.lit('{"input":{"request_id":"req_'), F.col("n"), F.lit('"},"general":{"search_engine":"google","results_cnt":'),
        F.col("n") * 1000, F.lit(',"search_time":0.25,"language":"en","mobile":'),
        F.when(F.col("n") % 2 == 0, "true").otherwise("false"), F.lit(',"timestamp":"2024-02-01T00:00:00.000Z"}'),
    )
    entries = F.array_join(F.transform("rows", lambda r: r["entry"]), ",")
    body = F.when(F.col("n") % 5 == 4, F.concat(head, F.lit("}"))).otherwise(
        F.concat(head, F.lit(',"organic":['), entries, F.lit("]}"))
    )
    return grouped.select(
        F.concat(F.lit("query "), F.col("n")).alias("search_query"),
        (F.col("n") % 3 * 10).cast("string").alias("pagination_start"),
        F.to_json(F.struct(body.alias("body"))).alias("response"),
    )
