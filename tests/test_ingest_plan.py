"""Ingest with enrichment of changed threads only, against the full view."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import final_plan, rows
from threadloom.operators.flatten import REDDIT, platform_items
from threadloom.operators.merge import part_of
from threadloom.plans import ingest
from threadloom.schemas import REDDIT_DATASET_ID
from threadloom.streaming.ingest import read_ingested

AS_OF = dt.datetime(2024, 3, 1)


def post(post_id, title, *comments):
    return {"post_id": post_id, "title": title, "date_posted": "2024-02-01T00:00:00Z", "comments": [{"comment": c, "user_commenting": "u"} for c in comments]}


def drop(root, number, posts):
    path = root / "drops" / REDDIT_DATASET_ID / f"s_{number}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(posts))


def test_changed_threads_give_the_full_view(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    seen, flattened = [], []
    down = {"word": "broken"}

    def embed(pending):
        seen.append({r.content for r in pending.select("content").collect()})
        return pending.select(
            "content_item_id", F.array(F.length("content").cast("double")).alias("embeddings"), F.lit("m").alias("embedding_model_name"),
            F.when(F.col("content").contains(down["word"]), "no quota").otherwise("").alias("embedding_status"),
        )

    def score(pending):
        zero = F.lit(0.5)
        return pending.select("content_item_id", zero.alias("sentiment_score"), zero.alias("sentiment_magnitude"), F.lit("").alias("sentiment_status"))

    whole = ingest.platform_items
    monkeypatch.setattr(ingest, "platform_items", lambda raw, platform: flattened.append({r.post_id for r in raw.select("post_id").collect()}) or whole(raw, platform))
    batches = [
        [post("a", "first", "one"), post("b", "second broken"), post(None, "lost")],
        [post("c", "third", "two", "three")],
        [post("a", "first again", "one", "four"), post("d", "fourth")],
        [post("e", "fifth")],
    ]
    for number, posts in enumerate(batches):
        if number == 2:
            down["word"] = "nothing"  # the provider works again
        drop(tmp_path, number, posts)
        cache = ingest.ingest_and_enrich(spark, str(tmp_path / "drops"), "Reddit", root, AS_OF, embed, score, lookback=None)
        full = platform_items(read_ingested(spark, f"{root}/raw"), REDDIT)
        want = {r.content_item_id for r in full.collect() if number >= 2 or "broken" not in r.primary_text}
        have = {r.unified_id for r in cache.collect() if r.embeddings}
        assert want <= have, number
    assert flattened == [{"a", "b"}, {"b", "c"}, {"a", "b", "d"}, {"e"}]  # b is tried again until it succeeds
    assert seen[1] == {"second broken", "third", "two", "three"} and seen[2] == {"second broken", "four", "fourth"} and seen[3] == {"fifth"}


def test_other_parts_are_not_read(spark, tmp_path):
    root = str(tmp_path / "threads")
    raw = spark.range(400).select(F.col("id").cast("string").alias("post_id"), F.lit("x").alias("title"))
    ingest.store_threads(raw, root, 0)
    ingest.store_threads(raw.filter("post_id = '7'").withColumn("title", F.lit("y")), root, 1)
    ingest.store_threads(raw.filter("post_id = '7'").withColumn("title", F.lit("y")), root, 1)  # the batch comes again
    one = spark.createDataFrame([("7",)], "post_id string")
    found = ingest.threads_of(spark, root, one)
    assert rows(found, "post_id", "title") == [("7", "x"), ("7", "y")]
    part = one.select(part_of("post_id", ingest.THREAD_PARTS)).first()[0]
    plan = final_plan(found)
    assert f"= {part})" in plan.split("PartitionFilters: [")[1].split("]")[0]
