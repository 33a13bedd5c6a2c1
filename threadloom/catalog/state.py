"""Queries over sinks, run state, watermarks and checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import fixtures as fx
from threadloom.operators import quality, runs
from threadloom.operators.merge import merge_into, read_current
from threadloom.operators.sinks import append_checked, read_checked, write_clustered
from threadloom.session import run_dir


def append_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents appended under rules; the accepted and rejected rows as read back."""
    path = run_dir(spark, "append")
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    rules = {"short": F.col("n_chars") < 3000, "not_german": F.col("lang") != "de"}
    status = append_checked(docs, path, rules)
    accepted, rejected = read_checked(spark, path), read_checked(spark, path, "rejected")
    return (
        accepted.withColumn("failed_rules", F.lit(""))
        .unionByName(rejected.withColumn("failed_rules", F.array_join("failed_rules", ",")))
        .withColumn("status", F.lit(status))
    )


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written by day and read back: rows, and that each file is in order."""
    path = run_dir(spark, "clustered")
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    write_clustered(events, path, "ts", ["event_type", "user_id"])
    return spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("event_id").alias("first_event"), F.sum("user_id").alias("users")
    )


_CACHE = ["embeddings", "embedding_model_name", "sentiment_score"]


def _cache_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vectors as a cache with gaps, and as results for some known and some new ids."""
    n = F.col("unified_id").cast("bigint")
    base = fx.vectors(spark, sf_dir)
    empty = F.array().cast("array<double>")
    target = base.filter((n % 3 != 0) | (n % 2 != 0)).select(
        "unified_id",
        F.when(n % 5 == 0, empty).when(n % 5 == 1, F.lit(None)).otherwise(F.col("embeddings")).alias("embeddings"),
        F.lit("first").alias("embedding_model_name"),
        F.when(n % 4 != 0, F.col("label").cast("double")).alias("sentiment_score"),
    )
    source = base.filter(n % 2 == 0).select(
        "unified_id",
        F.transform("embeddings", lambda x: x * 2).alias("embeddings"),
        F.lit("second").alias("embedding_model_name"),
        (F.col("label") + 100).cast("double").alias("sentiment_score"),
    )
    return target, source


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache and later results, merged bucket by bucket and read back."""
    target, source = _cache_halves(spark, sf_dir)
    root = run_dir(spark, "cache")
    schema = "unified_id string, embeddings array<double>, embedding_model_name string, sentiment_score double"
    for part in (target, source):
        merge_into(part, root, "unified_id", _CACHE, schema)
    return read_current(spark, root, schema).select(
        "unified_id", "embedding_model_name", "sentiment_score",
        F.coalesce(F.size("embeddings"), F.lit(-1)).cast("bigint").alias("dims"),
        F.round(F.try_element_at("embeddings", F.lit(1)), 6).alias("first_value"),
    )


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as run events: a user is a run, an event type its status."""
    events = fx.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("seq"), F.col("ts").alias("at"),
        F.col("event_type").alias("status"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("num_topics"),
    )
    latest = runs.latest_runs(events, ["error_message", "num_topics"])
    return latest.withColumn("created_at", fx.text_time("created_at"))


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark rows of all events: their type is the table, their time the mark."""
    return fx.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"), F.col("ts").alias("last_processed_timestamp"), F.col("ts").alias("updated_at")
    )


def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = runs.current_watermarks(_marks(spark, sf_dir))
    return marks.select("table_name", fx.text_time("last_processed_timestamp"))


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after the mark of a watermark table that was written, advanced and read back."""
    path = run_dir(spark, "marks")
    now = dt.datetime(2024, 3, 1)
    runs.advance_watermark(spark, path, "events", runs.EPOCH, now)
    runs.advance_watermark(spark, path, "events", dt.datetime(2024, 1, 16), now)
    mark = runs.read_watermark(spark.read.parquet(path), "events")
    fresh = runs.incremental(fx.table(spark, sf_dir, "events"), "ts", mark)
    return fresh.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.min("event_id").alias("first_event"))


def late_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items inside the two-day reprocessing window."""
    from threadloom.operators.enrich import recently_loaded

    items = fx.document_items(spark, sf_dir)
    recent = items.filter(recently_loaded(F.col("record_load_timestamp"), dt.datetime(2024, 3, 1)))
    return recent.select("content_item_id", fx.text_time("record_load_timestamp"))


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique(fx.table(spark, sf_dir, "documents"), ["text"]).select(
        F.md5("text").alias("text_md5"), "n_rows"
    )


def item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether item ids collide across levels and platforms: repeated keys in the two raw tables' post ids."""
    versions = fx.reddit_data(spark, sf_dir).select("post_id").unionByName(fx.quora_data(spark, sf_dir).select("post_id"))
    return quality.check_unique(versions, ["post_id"])


def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents").join(fx.table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.check_not_null(docs, ["doc_id", "text", "quality", "toxic"])


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents").join(fx.table(spark, sf_dir, "labels"), "doc_id", "left").select(
        "doc_id", (F.col("quality") * 2 - F.col("toxic")).cast("double").alias("sentiment_score"),
        (F.col("n_chars") - 500).alias("sentiment_magnitude"), (F.col("n_chars") / 5000).alias("confidence_score"),
    )
    return quality.check_rules(docs, {**quality.score_rules(), **quality.label_rules()})


QUERIES = {
    "append_checked": append_split,
    "write_clustered": clustered,
    "merge_keep_first": merged,
    "latest_runs": run_states,
    "current_watermarks": watermarks,
    "incremental": incremental,
    "recently_loaded": late_window,
    "check_unique": duplicates,
    "check_post_ids": item_ids,
    "check_not_null": nulls,
    "check_rules": rules,
}

SQL = {
    "append_checked": """SELECT doc_id, lang, n_chars,
      concat_ws(',', CASE WHEN n_chars >= 3000 THEN 'short' END, CASE WHEN lang = 'de' THEN 'not_german' END) AS failed_rules,
      'completed_with_failures' AS status FROM documents""",
    "write_clustered": """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_events,
      min(event_id) AS first_event, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1, 2""",
    "merge_keep_first": """WITH t AS (SELECT * FROM embeddings WHERE vec_id % 3 <> 0 OR vec_id % 2 <> 0), s AS (SELECT * FROM embeddings WHERE vec_id % 2 = 0),
    j AS (SELECT coalesce(t.vec_id, s.vec_id) AS id, t.vec_id IS NOT NULL AS known, s.vec_id IS NOT NULL AS fresh,
                 coalesce(t.embedding, s.embedding) AS v, coalesce(t.label, s.label) AS label
          FROM t FULL JOIN s ON t.vec_id = s.vec_id)
    SELECT CAST(id AS VARCHAR) AS unified_id, CASE WHEN known THEN 'first' ELSE 'second' END AS embedding_model_name,
           CAST(CASE WHEN known AND id % 4 <> 0 THEN label WHEN fresh THEN label + 100 END AS DOUBLE) AS sentiment_score,
           CASE WHEN (known AND id % 5 > 1) OR fresh THEN len(v) ELSE -1 END AS dims,
           round(CASE WHEN known AND id % 5 > 1 THEN CAST(v[1] AS DOUBLE) WHEN fresh THEN CAST(v[1] AS DOUBLE) * 2 END, 6) AS first_value
    FROM j""",
    "latest_runs": """SELECT CAST(user_id AS VARCHAR) AS run_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS created_at,
      arg_max(event_type, (ts, event_id)) AS status,
      arg_max(props, (ts, event_id)) FILTER (event_type = 'error' AND props IS NOT NULL) AS error_message,
      arg_max("value", (ts, event_id)) FILTER (event_type = 'click' AND "value" IS NOT NULL) AS num_topics
      FROM events GROUP BY user_id""",
    "current_watermarks": """SELECT event_type AS table_name, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_processed_timestamp
      FROM events GROUP BY 1""",
    "incremental": """SELECT event_type, count(*) AS n_events, min(event_id) AS first_event FROM events
      WHERE ts > TIMESTAMP '2024-01-16' GROUP BY 1""",
    "recently_loaded": """SELECT CAST(doc_id AS VARCHAR) AS content_item_id,
      strftime(TIMESTAMP '2024-03-01' - to_days(CAST(doc_id % 5 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS record_load_timestamp
      FROM documents WHERE doc_id % 5 <= 2""",
    "check_unique": "SELECT md5(text) AS text_md5, count(*) AS n_rows FROM documents GROUP BY text HAVING count(*) > 1",
    "check_post_ids": """WITH v AS (
      SELECT 'p' || conv_id AS post_id, conv_id FROM conversations WHERE turn = 0
      UNION ALL SELECT 'q' || conv_id, conv_id FROM conversations WHERE turn = 0)
      SELECT post_id, CASE WHEN conv_id % 9 = 0 THEN 3 ELSE 2 END AS n_rows FROM v WHERE conv_id % 3 = 0""",
    "check_not_null": """WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
      SELECT 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS n_nulls FROM d
      UNION ALL SELECT 'text', count(*) FILTER (text IS NULL) FROM d
      UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM d
      UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM d""",
    "check_rules": """WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
      SELECT 'sentiment_in_range' AS rule, count(*) FILTER (quality * 2 - toxic NOT BETWEEN -1 AND 1) AS n_broken FROM d
      UNION ALL SELECT 'magnitude_not_negative', count(*) FILTER (n_chars < 500) FROM d
      UNION ALL SELECT 'confidence_in_range', count(*) FILTER (n_chars > 5000) FROM d""",
}
