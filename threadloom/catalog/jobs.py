"""Queries that run whole jobs: streams and a topic run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import fixtures as fx
from threadloom.catalog.enrich import AS_OF, CACHE, cache, docs, lexicon
from threadloom.catalog.flatten import ITEMS, THREADS
from threadloom.catalog.ingest import WIRE_SQL, summary, write_drops
from threadloom.operators.enrich import embed_text, fit_embedder, score_sentiment
from threadloom.operators.runs import RUN_EVENTS, latest_runs, not_yet_done
from threadloom.operators.sinks import read_checked
from threadloom.plans.ingest import ingest_and_enrich
from threadloom.plans.topic_run import run_topics
from threadloom.schemas import REDDIT_DATASET_ID
from threadloom.session import run_dir
from threadloom.streaming.ingest import dedupe_stream, dedupe_with_late, ingest_messages, ingest_stream, read_ingested, rejected_drops

ITEMS_SQL = f"WITH {ITEMS}"
# The streams take a backlog in so many batches at most: each has a price of its own, whatever it holds.
MOST_BATCHES = 8


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dropped files streamed into the raw table, a few files per batch; a backlog in at most MOST_BATCHES batches."""
    root = run_dir(spark, "stream")
    query = ingest_stream(
        spark, write_drops(spark, sf_dir), "Reddit", f"{root}/reddit_data", f"{root}/checkpoints", "drops", files_per_batch=5, most_batches=MOST_BATCHES,
    )
    query.awaitTermination()
    return summary(read_ingested(spark, f"{root}/reddit_data"))


def messages_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Reddit records pushed as messages, some broken, some of another dataset: what was stored and what was not."""
    root = run_dir(spark, "messages")
    conv = F.col("conv_id")
    data = F.when(conv % 17 == 0, F.lit("***")).otherwise(F.base64(F.concat(F.lit("["), F.col("post"), F.lit("]")).cast("binary")))
    dataset = F.when(conv % 17 == 1, F.lit("gd_other")).otherwise(F.lit(REDDIT_DATASET_ID))
    attributes = F.create_map(F.lit("dataset_id"), dataset, F.lit("job_id"), F.col("snap"))
    messages = fx.reddit_wire(spark, sf_dir).select(data.alias("data"), attributes.alias("attributes"))
    for _ in range(2):  # delivered twice
        ingest_messages(messages, root, "b1")
    stored = read_checked(spark, f"{root}/Reddit").groupBy(F.lit("stored").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("post_id").alias("n_posts")
    )
    lost = spark.read.parquet(f"{root}/rejects").groupBy(F.col("reject_reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))
    return stored.unionByName(lost, allowMissingColumns=True)


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of dropped files, one per page: those that no platform takes."""
    page = F.col("page_id")
    folder = F.when(page % 3 == 0, F.lit(REDDIT_DATASET_ID + "/")).when(page % 3 == 1, F.lit("gd_other/")).otherwise(F.lit(""))
    paths = fx.table(spark, sf_dir, "pages").select(F.concat(F.lit("file:///drops/"), folder, page, F.lit(".json")).alias("file_path"))
    return rejected_drops(paths, "/drops")


def ingested_and_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped files to enriched items: how many items of each level carry a vector and a score."""
    root, given = run_dir(spark, "chain"), lexicon(spark)
    model = fit_embedder(docs(spark, sf_dir))
    cache_now = ingest_and_enrich(
        spark, write_drops(spark, sf_dir), "Reddit", root, AS_OF, lambda d: embed_text(d, model),
        lambda d: score_sentiment(d, given), lookback=None, files_per_batch=50, most_batches=MOST_BATCHES,
    )
    level = F.when(F.col("unified_id").startswith("reddit_comment"), "comment").when(F.col("unified_id").startswith("reddit_reply"), "reply").otherwise("post")
    return cache_now.groupBy(level.alias("content_type")).agg(
        F.count(F.lit(1)).alias("n_items"), F.countDistinct("unified_id").alias("n_ids"), F.count("embeddings").alias("n_vectors"),
        F.count("sentiment_score").alias("n_scores"),
    )


def run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions and mart of a run, read back in their declared columns."""
    root = run_dir(spark, "marts")
    items = fx.document_items(spark, sf_dir)
    result = run_topics(
        items, cache(spark, sf_dir), items.select(F.col("content_item_id").alias("unified_id")), root, k=4, as_of=AS_OF, run_id="run_2",
        seed=7, skip_projection=True, mart_keywords=3,
    )
    made = spark.read.parquet(result.tables["predictions"]).select("unified_id", "predicted_cluster")
    mart = spark.read.parquet(result.tables["mart"])
    both = mart.join(made.withColumnRenamed("unified_id", "content_item_id"), "content_item_id", "left")
    return both.select(
        "content_item_id", "processing_type", "sentiment_label", F.size("keyword_list").cast("bigint").alias("n_keywords"),
        F.col("topic_id").isNotNull().alias("in_topic"), F.col("topic_id").eqNullSafe(F.col("predicted_cluster")).alias("agrees"),
        (F.col("topic_label").isNotNull() == F.col("topic_id").isNotNull()).alias("labelled"),
    )


def streamed_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered twice in a stream, deduplicated by id within a watermark."""
    root = run_dir(spark, "twice")
    events = fx.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    events.unionByName(events).repartition(4).write.parquet(f"{root}/in")
    stream = dedupe_stream(spark.readStream.schema(events.schema).parquet(f"{root}/in"), ["event_id"], "ts", "60 days")
    query = (
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("ids")
    )


def streamed_with_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in batches of five days, repeats among them, deduplicated within six days: what was kept and what came too late.

    A tenth is sent again with the next batch (a repeat), a tenth three batches later (too late), and a tenth four batches
    later with a time twenty days on, when its first row is forgotten.
    """
    root = run_dir(spark, "late")
    events = fx.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    batch = F.floor(F.datediff("ts", F.lit("2024-01-01")) / 5)
    placed = events.withColumn("batch", batch)
    digit = F.col("event_id") % 10
    later = F.col("ts") + F.expr("INTERVAL 20 DAYS")
    again = [(0, 1, F.col("ts")), (1, 3, F.col("ts")), (2, 4, later)]
    sent = placed
    for tenth, steps, at in again:
        sent = sent.unionByName(placed.filter(digit == tenth).withColumns({"ts": at, "batch": F.col("batch") + steps}))
    last = placed.agg(F.max("batch")).first()[0]
    sent.filter(F.col("batch") <= last).write.partitionBy("batch").parquet(f"{root}/sent")
    for number in range(last + 1):  # each batch arrives when the one before is through, in as many files as tasks wrote it
        spark.read.parquet(f"{root}/sent").filter(F.col("batch") == number).drop("batch").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        dedupe_with_late(stream, ["event_id"], "ts", dt.timedelta(days=6), root, f"{root}/checkpoint").awaitTermination()
    counts = [F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("ids")]
    out = [spark.read.parquet(f"{root}/{name}").groupBy(F.lit(name).alias("outcome"), "event_type").agg(*counts) for name in ("kept", "late")]
    return out[0].unionByName(out[1])


def taken_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken in rounds: the even ones to a time, then all, then all again; what each round takes."""
    events = fx.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    there = events.filter((F.col("event_id") % 2 == 0) & (F.col("ts") <= F.lit(dt.datetime(2024, 1, 16))))
    done, rounds = there, [there]
    for _ in range(2):
        fresh = not_yet_done(events, "ts", "event_id", done.agg(F.max("ts")).first()[0], done, dt.timedelta(days=2))
        rounds.append(fresh)
        done = done.unionByName(fresh)
    out = [r.groupBy(F.lit(n).alias("round"), "event_type").agg(F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("ids")) for n, r in enumerate(rounds)]
    return out[0].unionByName(out[1]).unionByName(out[2])


def topic_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over all documents with vectors: what it wrote, and the state it ended in."""
    root = run_dir(spark, "run")
    items = fx.document_items(spark, sf_dir)
    ids = items.select(F.col("content_item_id").alias("unified_id"))
    result = run_topics(
        items, cache(spark, sf_dir), ids, root, k=4, as_of=AS_OF, run_id="run_1", description="all", seed=7,
    )
    assigned = spark.read.parquet(result.tables["assignments"]).select("unified_id", "topic_id")
    placed = spark.read.parquet(result.tables["coordinates"]).select("unified_id", "umap_x", "umap_y")
    labels = spark.read.parquet(result.tables["labels"])
    state = latest_runs(spark.read.schema(RUN_EVENTS).parquet(f"{root}/kmeans_runs"))
    counted = assigned.join(placed, "unified_id").join(labels.select("topic_id", "topic_label"), "topic_id").agg(
        F.count(F.lit(1)).alias("n_documents"), F.countDistinct("topic_id").alias("n_topics"),
        F.count("topic_label").alias("n_labelled"), F.lit("run_1").alias("run_id"),
    )
    return counted.join(state, "run_id").select(
        "run_id", "n_documents", "n_topics", "n_labelled", "status", "num_topics", "description", "error_message"
    )


QUERIES = {
    "ingest_stream": streamed,
    "ingest_messages": messages_in,
    "ingest_rejects": rejects,
    "ingest_and_enrich": ingested_and_enriched,
    "run_tables": run_tables,
    "dedupe_stream": streamed_once,
    "run_topics": topic_run,
    "dedupe_late": streamed_with_late,
    "incremental_once": taken_once,
}

SQL = {
    "ingest_stream": WIRE_SQL,
    "ingest_messages": f"""WITH {THREADS},
      m AS (SELECT conv_id, k FROM said JOIN (VALUES (0), (1), (2)) x(k) ON k <= snap WHERE turn = 0)
      SELECT 'stored' AS outcome, count(*) AS n_rows, count(DISTINCT conv_id) AS n_posts FROM m WHERE conv_id % 17 > 1
      UNION ALL SELECT CASE conv_id % 17 WHEN 0 THEN 'bad_base64' ELSE 'unknown_dataset_id' END, count(*), NULL
      FROM m WHERE conv_id % 17 <= 1 GROUP BY 1""",
    "ingest_rejects": """SELECT 'file:///drops/' || CASE page_id % 3 WHEN 1 THEN 'gd_other/' ELSE '' END || page_id || '.json' AS file_path,
      CASE page_id % 3 WHEN 1 THEN 'gd_other' END AS dataset_id,
      CASE page_id % 3 WHEN 1 THEN 'unknown_dataset_id' ELSE 'path_too_short' END AS reject_reason FROM pages WHERE page_id % 3 <> 0""",
    "ingest_and_enrich": rf"""{ITEMS_SQL}
      SELECT content_type, count(DISTINCT content_item_id) AS n_items, count(DISTINCT content_item_id) AS n_ids,
        count(DISTINCT content_item_id) AS n_vectors, count(DISTINCT content_item_id) AS n_scores
      FROM items WHERE source = 'Reddit' AND regexp_matches(primary_text, '[\p{{L}}\p{{N}}]') GROUP BY 1""",
    "run_tables": rf"""WITH {CACHE},
      words AS (SELECT doc_id, count(DISTINCT term) AS n FROM (
        SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+')) AS term FROM documents) WHERE term <> '' GROUP BY 1)
      SELECT CAST(d.doc_id AS VARCHAR) AS content_item_id, 'ad_hoc_consultant' AS processing_type,
             CASE WHEN c.sentiment_score IS NULL THEN 'Error' WHEN c.sentiment_score >= 0.25 THEN 'Positive'
                  WHEN c.sentiment_score <= -0.25 THEN 'Negative' ELSE 'Neutral' END AS sentiment_label,
             least(3, coalesce(w.n, 0)) AS n_keywords, coalesce(NOT c.no_vector, false) AS in_topic, true AS agrees, true AS labelled
      FROM documents d LEFT JOIN cache c ON c.vec_id = d.doc_id LEFT JOIN words w ON w.doc_id = d.doc_id""",
    "dedupe_stream": "SELECT event_type, count(*) AS n_events, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1",
    "dedupe_late": """WITH e AS (SELECT *, date_diff('day', DATE '2024-01-01', ts::DATE) // 5 AS batch FROM events),
      kept AS (SELECT event_type, event_id FROM e UNION ALL
        SELECT event_type, event_id FROM e WHERE event_id % 10 = 2 AND batch + 4 <= (SELECT max(batch) FROM e)),
      late AS (SELECT event_type, event_id FROM e WHERE event_id % 10 = 1 AND batch + 3 <= (SELECT max(batch) FROM e))
      SELECT 'kept' AS outcome, event_type, count(*) AS n_events, sum(event_id)::BIGINT AS ids FROM kept GROUP BY event_type
      UNION ALL SELECT 'late', event_type, count(*), sum(event_id)::BIGINT FROM late GROUP BY event_type""",
    "incremental_once": """WITH one AS (SELECT * FROM events WHERE event_id % 2 = 0 AND ts <= TIMESTAMP '2024-01-16'),
      two AS (SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM one) - INTERVAL 2 DAYS AND event_id NOT IN (SELECT event_id FROM one))
      SELECT 0 AS round, event_type, count(*) AS n_events, sum(event_id)::BIGINT AS ids FROM one GROUP BY event_type
      UNION ALL SELECT 1, event_type, count(*), sum(event_id)::BIGINT FROM two GROUP BY event_type""",
    "run_topics": f"""WITH {CACHE}
      SELECT 'run_1' AS run_id, count(*) AS n_documents, 4 AS n_topics, count(*) AS n_labelled, 'completed' AS status,
             4 AS num_topics, 'all' AS description, NULL AS error_message
      FROM cache WHERE NOT no_vector AND vec_id IN (SELECT doc_id FROM documents)""",
}
