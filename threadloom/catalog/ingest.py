"""Queries over the sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import fixtures as fx
from threadloom.catalog.flatten import THREADS
from threadloom.schemas import QUORA_DATASET_ID, QUORA_WIRE, REDDIT_DATASET_ID, REDDIT_WIRE
from threadloom.session import run_dir
from threadloom.sources.drops import read_raw_json, with_drop_metadata
from threadloom.sources.envelopes import decode_envelopes
from threadloom.sources.links import clean_links, scrape_manifest, selection
from threadloom.sources.normalize import normalize_quora, normalize_reddit
from threadloom.sources.routing import route
from threadloom.sources.search import serp_results, serp_searches


def write_drops(spark: SparkSession, sf_dir: str) -> str:
    """Drop the Reddit records as array files of at most 100 records; returns the folder."""

    def build(spark: SparkSession, sf_dir: str) -> str:
        path = run_dir(spark, "drops")
        files = fx.reddit_wire(spark, sf_dir).groupBy(F.floor(F.col("conv_id") / 100).alias("batch"), "snap", "page").agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("post"), ",\n"), F.lit("]")).alias("value")
        )
        files.select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/{REDDIT_DATASET_ID}")
        return path

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DROPS:
        _DROPS[key] = build(spark, sf_dir)
    return _DROPS[key]


_DROPS: dict[tuple[str, str], str] = {}


def summary(posts: DataFrame) -> DataFrame:
    """Normalised Reddit rows as scalars."""
    comments = F.col("comments")
    replies = F.flatten(F.transform(comments, lambda c: c["replies"]))
    return posts.select(
        "post_id", "title", "description", "num_upvotes", fx.text_time("date_posted"), fx.text_time("timestamp"),
        F.size("photos").cast("bigint").alias("n_photos"),
        F.size("embedded_links").cast("bigint").alias("n_links"),
        F.col("community_rank.community_rank_type").alias("rank_type"),
        F.col("community_rank").isNull().alias("no_rank"),
        F.size(comments).cast("bigint").alias("n_comments"),
        F.size(replies).cast("bigint").alias("n_replies"),
        F.aggregate(comments, F.lit(0).cast("bigint"), lambda s, c: s + c["num_upvotes"]).alias("comment_votes"),
        F.aggregate(replies, F.lit(0).cast("bigint"), lambda s, r: s + r["num_upvotes"]).alias("reply_votes"),
        F.date_format(F.array_max(F.transform(comments, lambda c: c["date_of_comment"])), "yyyy-MM-dd HH:mm:ss").alias("last_comment"),
    )


def read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_raw_json(spark, write_drops(spark, sf_dir), REDDIT_WIRE)
    return summary(normalize_reddit(raw.withColumn("snapshot_id", F.lit("s"))))


def normalized_reddit(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = fx.reddit_wire(spark, sf_dir).select(
        F.from_json("post", REDDIT_WIRE).alias("p"), F.col("snap").alias("snapshot_id")
    )
    return summary(normalize_reddit(wire.select("p.*", "snapshot_id")))


def normalized_quora(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = fx.quora_data(spark, sf_dir)
    wire = data.select(F.from_json(F.to_json(F.struct(*data.columns)), QUORA_WIRE).alias("p"), "snapshot_id")
    posts = normalize_quora(wire.select("p.*", "snapshot_id"))
    return posts.select(
        "post_id", "title", "post_text", "author_name", "upvotes", "videos_urls", "snapshot_id",
        fx.text_time("post_date"), fx.text_time("timestamp"),
        F.size("pictures_urls").cast("bigint").alias("n_pictures"),
        F.size("top_comments").cast("bigint").alias("n_comments"),
        F.size(F.flatten(F.transform("top_comments", lambda c: c["replys"]))).cast("bigint").alias("n_replies"),
        F.date_format(F.array_max(F.transform("top_comments", lambda c: c["comment_date"])), "yyyy-MM-dd HH:mm:ss").alias("last_comment"),
    )


def drop_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    name = F.concat(F.lit("s_"), page)
    path = (
        F.when(page % 4 == 0, F.concat(F.lit("file:///drops/d/"), name, F.lit(".json")))
        .when(page % 4 == 1, F.concat(F.lit("s3://drops/d/sub/"), name, F.lit(".json")))
        .when(page % 4 == 2, F.concat(F.lit("/drops/d/"), name))
        .otherwise(F.concat(F.lit("/drops/"), name, F.lit(".json")))
    )
    files = fx.table(spark, sf_dir, "pages").select("page_id", path.alias("file_path"))
    accepted, rejected = with_drop_metadata(files, root="/drops")
    return accepted.select("page_id", "dataset_id", "snapshot_id", F.lit(None).cast("string").alias("reject_reason")).unionByName(
        rejected.select("page_id", "reject_reason"), allowMissingColumns=True
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    array = F.concat(F.lit("["), F.col("post"), F.lit(',{"post_id":"x'), conv, F.lit('"}]'))
    payload = (
        F.when(conv % 17 == 0, F.lit("***"))
        .when(conv % 17 == 1, F.base64(F.col("post").cast("binary")))
        .when(conv % 17 == 2, F.base64(F.lit('[{"post_id": ').cast("binary")))
        .otherwise(F.base64(array.cast("binary")))
    )
    attributes = F.when(conv % 17 == 3, F.create_map(F.lit("dataset_id"), F.lit(REDDIT_DATASET_ID))).otherwise(
        F.create_map(F.lit("dataset_id"), F.lit(REDDIT_DATASET_ID), F.lit("job_id"), F.col("snap"))
    )
    messages = fx.reddit_wire(spark, sf_dir).select("conv_id", payload.alias("data"), attributes.alias("attributes"))
    accepted, rejected = decode_envelopes(messages, REDDIT_WIRE)
    return (
        accepted.select("conv_id", "dataset_id", "snapshot_id", "post_id", "warning_reason")
        .unionByName(rejected.select("conv_id", "dataset_id", "snapshot_id", "reject_reason"), allowMissingColumns=True)
        .distinct()
    )


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    dataset = F.when(page % 3 == 0, REDDIT_DATASET_ID).when(page % 3 == 1, QUORA_DATASET_ID).otherwise(F.lit("gd_other"))
    return route(fx.table(spark, sf_dir, "pages").select("page_id", dataset.alias("dataset_id")))


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serp_searches(fx.search_responses(spark, sf_dir)).withColumn("timestamp", fx.text_time("timestamp"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serp_results(fx.search_responses(spark, sf_dir)).withColumn("created_at", fx.text_time("created_at"))


def _pasted_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    pasted = F.when(page % 10 == 0, F.lit(" \t ")).when(page % 10 == 1, F.concat(F.lit("  "), "url", F.lit("\t"))).otherwise(F.col("url"))
    return fx.table(spark, sf_dir, "pages").select("page_id", pasted.alias("url"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_links(_pasted_links(spark, sf_dir), "url")


def distinct_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_links(_pasted_links(spark, sf_dir), "url", distinct=True).select("url")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    batches = clean_links(_pasted_links(spark, sf_dir), "url").select(
        F.when(page % 2 == 0, REDDIT_DATASET_ID).otherwise(QUORA_DATASET_ID).alias("dataset_id"),
        F.concat(F.lit("s_"), F.floor(page / 100)).alias("snapshot_id"), page.alias("position"), "url",
    )
    headers, rows = scrape_manifest(batches, dt.datetime(2024, 3, 1))
    return rows.unionByName(headers.withColumn("initiated_at", fx.text_time("initiated_at")), allowMissingColumns=True)


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    pasted = F.when(doc % 7 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.floor(doc / 2), F.lit("\n")))
    return selection(fx.table(spark, sf_dir, "documents").select(pasted.alias("id")), "id")


QUERIES = {
    "read_raw_json": read_raw,
    "drop_metadata": drop_metadata,
    "decode_envelopes": envelopes,
    "route": routed,
    "normalize_reddit": normalized_reddit,
    "normalize_quora": normalized_quora,
    "serp_searches": searches,
    "serp_results": results,
    "clean_links": links,
    "distinct_links": distinct_links,
    "scrape_manifest": manifest,
    "selection": selected,
}

WIRE_SQL = f"""WITH {THREADS},
snaps AS (SELECT s.*, k, (conv_id * 7 + turn * 3 + k) % 100 AS v FROM said s JOIN (VALUES (0), (1), (2)) x(k) ON k <= snap),
threads AS (
  SELECT conv_id, k, count(*) FILTER (turn % 2 = 1) AS n_comments, count(*) FILTER (turn > 0 AND turn % 2 = 0) AS n_replies,
         coalesce(sum(v) FILTER (turn % 2 = 1), 0) AS comment_votes,
         coalesce(sum(v) FILTER (turn > 0 AND turn % 2 = 0), 0) AS reply_votes,
         max(tm) FILTER (turn % 2 = 1) AS last_comment
  FROM snaps GROUP BY 1, 2)
SELECT 'p' || p.conv_id AS post_id, CASE WHEN p.conv_id % 11 <> 0 THEN p.text END AS title,
       CASE WHEN p.conv_id % 2 = 0 THEN 'body of ' || p.conv_id END AS description,
       CASE WHEN p.conv_id % 6 IN (0, 1, 2, 4) THEN p.v END AS num_upvotes,
       strftime(CASE p.conv_id % 5 WHEN 0 THEN p.tm WHEN 1 THEN p.tm - INTERVAL 2 HOUR WHEN 3 THEN date_trunc('day', p.tm) END,
                '%Y-%m-%d %H:%M:%S') AS date_posted,
       strftime(TIMESTAMP '2024-03-01' + to_days(p.k), '%Y-%m-%d %H:%M:%S') AS "timestamp",
       CASE WHEN p.conv_id % 4 = 0 THEN 2 ELSE 0 END AS n_photos, 0 AS n_links,
       CASE WHEN p.conv_id % 3 = 0 THEN 'top' END AS rank_type, p.conv_id % 3 <> 0 AS no_rank,
       n_comments, n_replies, CAST(comment_votes AS BIGINT) AS comment_votes, CAST(reply_votes AS BIGINT) AS reply_votes,
       strftime(last_comment, '%Y-%m-%d %H:%M:%S') AS last_comment
FROM snaps p JOIN threads t USING (conv_id, k) WHERE p.turn = 0"""

_LINKS = """WITH links AS (
  SELECT page_id, split_part(url, '?', 1) AS url FROM pages WHERE page_id % 10 <> 0)
"""

SQL = {
    "read_raw_json": WIRE_SQL,
    "drop_metadata": """SELECT page_id, CASE WHEN page_id % 4 <> 3 THEN 'd' END AS dataset_id,
      CASE WHEN page_id % 4 <> 3 THEN 's_' || page_id END AS snapshot_id,
      CASE WHEN page_id % 4 = 3 THEN 'path_too_short' END AS reject_reason FROM pages""",
    "decode_envelopes": f"""WITH {THREADS},
    m AS (SELECT conv_id, k, conv_id % 17 AS c FROM said JOIN (VALUES (0), (1), (2)) x(k) ON k <= snap WHERE turn = 0)
    SELECT conv_id, '{REDDIT_DATASET_ID}' AS dataset_id, CASE WHEN c <> 3 THEN 's_' || k END AS snapshot_id, post_id,
           CASE WHEN c = 3 THEN 'missing_job_id' END AS warning_reason, NULL AS reject_reason
    FROM (SELECT *, unnest(['p' || conv_id, 'x' || conv_id]) AS post_id FROM m WHERE c > 2) GROUP BY ALL
    UNION ALL
    SELECT conv_id, '{REDDIT_DATASET_ID}', 's_' || k, NULL, NULL,
           CASE c WHEN 0 THEN 'bad_base64' WHEN 1 THEN 'not_a_list' ELSE 'bad_json' END FROM m WHERE c <= 2""",
    "route": f"""SELECT page_id,
      CASE page_id % 3 WHEN 0 THEN '{REDDIT_DATASET_ID}' WHEN 1 THEN '{QUORA_DATASET_ID}' ELSE 'gd_other' END AS dataset_id,
      CASE page_id % 3 WHEN 0 THEN 'Reddit' WHEN 1 THEN 'Quora' END AS platform,
      CASE WHEN page_id % 3 = 2 THEN 'unknown_dataset_id' END AS reject_reason FROM pages""",
    "normalize_reddit": WIRE_SQL,
    "normalize_quora": f"""WITH {THREADS},
    t AS (SELECT conv_id, count(*) FILTER (turn % 2 = 1) AS n_comments, count(*) FILTER (turn > 0 AND turn % 2 = 0) AS n_replies,
                 max(tm) FILTER (turn % 2 = 1) AS last_comment FROM said GROUP BY 1)
    SELECT post_id, text AS title, body AS post_text, author AS author_name, (conv_id * 7 + k) % 100 AS upvotes,
           CASE WHEN conv_id % 4 = 1 THEN 'https://vid.example/' || conv_id END AS videos_urls, 's_' || k AS snapshot_id,
           strftime(tm, '%Y-%m-%d %H:%M:%S') AS post_date,
           strftime(TIMESTAMP '2024-03-01' + to_days(k), '%Y-%m-%d %H:%M:%S') AS "timestamp",
           CASE WHEN conv_id % 3 = 0 THEN 1 ELSE 0 END AS n_pictures, n_comments, n_replies,
           strftime(last_comment, '%Y-%m-%d %H:%M:%S') AS last_comment
    FROM q_posts JOIN t USING (conv_id) JOIN (VALUES (0), (1), (2)) x(k) ON k <= snap""",
    "serp_searches": """SELECT 'req_' || n AS request_id, 'query ' || n AS search_query, 'google' AS search_engine,
      n * 1000 AS results_count, CAST(0.25 AS DOUBLE) AS search_time, 'en' AS language,
      CASE WHEN n % 2 = 0 THEN 'True' ELSE 'False' END AS is_mobile, '2024-02-01 00:00:00' AS "timestamp",
      CAST(n % 3 * 10 AS VARCHAR) AS pagination_start
      FROM (SELECT DISTINCT page_id // 10 AS n FROM pages)""",
    "serp_results": """SELECT md5('req_' || n || ':' || (row_number() OVER (PARTITION BY n ORDER BY page_id) - 1)) AS id,
      'query ' || n AS query, 'req_' || n AS serp_request_id, url AS link, 'page ' || page_id AS title,
      CASE page_id % 3 WHEN 0 THEN '' WHEN 2 THEN 'about ' || page_id END AS description,
      page_id % 10 + 1 AS rank, page_id + 1 AS global_rank, '2024-02-01 00:00:00' AS created_at
      FROM (SELECT *, page_id // 10 AS n FROM pages) WHERE n % 5 <> 4""",
    "clean_links": _LINKS + "SELECT page_id, url FROM links",
    "distinct_links": _LINKS + "SELECT DISTINCT url FROM links",
    "scrape_manifest": _LINKS + f""", b AS (
      SELECT CASE WHEN page_id % 2 = 0 THEN '{REDDIT_DATASET_ID}' ELSE '{QUORA_DATASET_ID}' END AS dataset_id,
             's_' || page_id // 100 AS snapshot_id, page_id AS position, url FROM links)
    SELECT dataset_id, snapshot_id, position, url, NULL AS total_urls_count, NULL AS initiated_at FROM b
    UNION ALL SELECT dataset_id, snapshot_id, NULL, NULL, count(*), '2024-03-01 00:00:00' FROM b GROUP BY 1, 2""",
    "selection": "SELECT DISTINCT CAST(doc_id // 2 AS VARCHAR) AS unified_id FROM documents WHERE doc_id % 7 <> 0",
}
