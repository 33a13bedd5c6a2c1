import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import final_plan, rows
from threadloom.operators import marts, runs, topics
from threadloom.operators.quality import QualityError
from threadloom.plans.topic_run import new_run_id, run_topics

NOW = dt.datetime(2024, 3, 1)
N = 60


@pytest.fixture(scope="module")
def cache(spark):
    """Three clear directions, a zero vector, an empty one and a missing one."""
    good = spark.range(N).selectExpr(
        "concat('i', id) unified_id",
        "transform(sequence(0, 2), d -> if(d = id % 3, 1.0, 0.0) + 0.01 * ((id * (d + 1)) % 5)) embeddings",
        "cast(id % 3 - 1 as double) sentiment_score", "1.0D sentiment_magnitude",
    )
    bad = spark.createDataFrame(
        [("zero", [0.0, 0.0, 0.0], 0.0, 0.0), ("empty", [], 0.0, 0.0), ("none", None, 0.0, 0.0)],
        "unified_id string, embeddings array<double>, sentiment_score double, sentiment_magnitude double",
    )
    return good.selectExpr("unified_id", "cast(embeddings as array<double>) embeddings", "sentiment_score", "sentiment_magnitude").unionByName(bad)


@pytest.fixture(scope="module")
def items(spark):
    words = ["apple pie", "motor car", "river bank"]
    choice = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(N + 10).select(
        F.concat(F.lit("i"), "id").alias("content_item_id"), F.lit("Reddit").alias("source"), F.lit("post").alias("content_type"),
        F.lit(NOW).alias("content_timestamp"), F.concat(choice, F.lit(" number "), F.col("id")).alias("primary_text"),
        F.lit("ctx").alias("full_text_context"), F.lit(None).cast("string").alias("parent_content_item_id"),
        F.concat(F.lit("i"), "id").alias("top_level_post_id"),
    )


def ids_of(items):
    return items.select(F.col("content_item_id").alias("unified_id"))


def test_only_usable_vectors(spark, cache):
    assert topics.vectors_for(cache).count() == N
    some = spark.createDataFrame([("i1",), ("zero",), ("absent",)], "unified_id string")
    assert rows(topics.vectors_for(cache, some), "unified_id") == [("i1",)]
    assert topics.coverage(cache, some).first() == (3, 1)


def test_a_short_id_list_is_broadcast(spark, cache):
    some = spark.createDataFrame([(f"i{i}",) for i in range(40)], "unified_id string")
    assert "BroadcastHashJoin" in final_plan(topics.vectors_for(cache, some))


@pytest.mark.parametrize("k", [1, 0, "5", 2.0, True, None])
def test_topic_count_is_checked(k):
    with pytest.raises(ValueError):
        topics.check_topic_count(k)


def test_vectors_of_two_lengths_are_refused(spark):
    df = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], "unified_id string, embeddings array<double>")
    with pytest.raises(ValueError, match="differ in length"):
        topics.fit_topics(df, 2)
    with pytest.raises(ValueError, match="no usable vectors"):
        topics.fit_topics(df.filter("false"), 2)


def test_fit_and_assign(spark, cache):
    vectors = topics.vectors_for(cache)
    model = topics.fit_topics(vectors, 3, seed=5)
    again = topics.fit_topics(vectors.repartition(5), 3, seed=5)
    assert [list(c) for c in model.clusterCenters()] == [list(c) for c in again.clusterCenters()]
    centers = topics.centers_of(spark, model)
    every = topics.centroid_distances(vectors, centers)
    assigned = topics.assign_topics(vectors, centers)
    got = {r["unified_id"]: (r["topic_id"], r["assignment_score"]) for r in assigned.collect()}
    for r in every.collect():
        near = r["nearest_centroids"]
        assert [x["distance"] for x in near] == sorted(x["distance"] for x in near) and len(near) == 3
        assert got[r["unified_id"]] == (near[0]["topic_id"], near[0]["distance"])
    groups = {}
    for name, (topic, _) in got.items():
        groups.setdefault(topic, set()).add(int(name[1:]) % 3)
    assert set(groups) == {1, 2, 3} and all(len(g) == 1 for g in groups.values())
    assert "Python" not in final_plan(assigned)


@pytest.fixture(scope="module")
def assignments(spark, items, cache):
    vectors = topics.item_vectors(items, cache)
    centers = topics.mean_centers(vectors, F.substring("unified_id", 2, 9).cast("bigint") % 3 + 1)
    return topics.topic_assignments(topics.assign_topics(vectors, centers), "run", NOW)


def test_top_documents(assignments):
    top = topics.top_documents(assignments, "run", num_docs=4, max_text_length=8).collect()
    assert len(top) == 3 and all(r["num_documents"] == 4 for r in top)
    assert all([len(t) for t in r["topic_documents"].split("\n---\n")] == [8] * 4 for r in top)
    assert topics.top_documents(assignments, "other").count() == 0


def test_top_documents_are_cut_before_the_shuffle(assignments):
    assert final_plan(topics.ranked_documents(assignments, "run", 4)).count("WindowGroupLimit") == 2


def test_prompt_holds_the_documents(assignments):
    prompt = topics.topic_prompts(topics.top_documents(assignments, "run", 2)).first()["prompt"]
    assert "\n---\n" in prompt and all(p in prompt for p in ("LABEL:", "DESCRIPTION:", "CONFIDENCE:"))


def test_labels_name_what_sets_topics_apart(assignments):
    labels = {r["topic_id"]: r for r in topics.label_topics(assignments, "run", NOW, num_terms=2).collect()}
    assert {k: set(v["topic_label"].split()) for k, v in labels.items()} == {
        1: {"apple", "pie"}, 2: {"car", "motor"}, 3: {"bank", "river"},
    }
    assert all(r["confidence_score"] == 1.0 and r["num_documents_used"] == 10 for r in labels.values())


def answer(text, **more):
    return json.dumps({"candidates": [{"content": {"parts": [{"text": text}]}, **more}], "model_version": "m"})


@pytest.mark.parametrize(
    "response,label,description,confidence",
    [
        (answer("LABEL: A b\nDESCRIPTION: Some. Text.\nCONFIDENCE: 0.9"), "A b", "Some. Text.", 0.9),
        (answer("intro\nLABEL: A LABEL:b\nLABEL: no\nDESCRIPTION: d\nCONFIDENCE: .5"), "A b", "d", 0.5),
        (answer("LABEL: " + "w " * 15 + "\nDESCRIPTION: d\nCONFIDENCE: 1"), ("w " * 15).strip(), "d", 1.0),
        (answer("LABEL: " + "w " * 16 + "\nDESCRIPTION: d\nCONFIDENCE: 1"), "Error: Invalid response format", None, 0.0),
        (answer("LABEL:\nDESCRIPTION: d\nCONFIDENCE: 1"), "Error: Invalid response format", None, 0.0),
        (answer("LABEL: a\nDESCRIPTION: \nCONFIDENCE: 1"), "Error: Invalid response format", None, 0.0),
        (answer("LABEL: a\nDESCRIPTION: a.b.c.d.e.f.\nCONFIDENCE: 1"), "a", "a.b.c.d.e.f.", 1.0),
        (answer("LABEL: a\nDESCRIPTION: a.b.c.d.e.f.g.\nCONFIDENCE: 1"), "Error: Invalid response format", None, 0.0),
        (answer("LABEL: a\nDESCRIPTION: d\nCONFIDENCE: 1.01"), "Error: Invalid response format", None, 0.0),
        (answer("LABEL: a\nDESCRIPTION: d\nCONFIDENCE: 1d"), "Error: Invalid response format", None, 0.0),
        (answer(" LABEL: a\n DESCRIPTION: d\nCONFIDENCE: 1"), "Error: Invalid response format", None, 0.0),
        ('{"candidates": []}', "Error: No candidates in response", "", 0.0),
        ('{"candidates": [{}]}', "Error: No content parts in candidate", "", 0.0),
        ("no json", "Error: Invalid JSON response", None, 0.0),
    ],
)
def test_label_responses(spark, response, label, description, confidence):
    given = spark.createDataFrame(
        [(1, response, "p", 10, 0.5)], "topic_id bigint, response string, prompt string, num_documents bigint, avg_assignment_score double"
    )
    row = topics.parse_label_responses(given, "run", NOW).first()
    assert (row["topic_label"], row["confidence_score"]) == (label, confidence)
    if description == "":
        assert row["topic_description"] is None
    elif description is None:
        assert row["topic_description"].startswith("Raw response: ") and row["topic_description"].endswith("...")
        assert "raw_response" in json.loads(row["model_metadata"])
    else:
        assert row["topic_description"] == description
        metadata = json.loads(row["model_metadata"])
        assert metadata["model_version"] == "m" and metadata["score"] == 0 and metadata["prompt_used"] == "p"


def test_a_whole_run(spark, items, cache, tmp_path):
    root = str(tmp_path)
    seen = []

    def labeller(prompts):
        seen.append(prompts.columns)
        return prompts.select("topic_id", F.lit(answer("LABEL: x\nDESCRIPTION: d\nCONFIDENCE: 0.5")).alias("response"))

    result = run_topics(items, cache, ids_of(items), root, k=3, as_of=NOW, run_id="r1", projection={"epochs": 2}, labeller=labeller)
    assert (result.requested, result.found, result.errors) == (N + 10, N, {})
    events = spark.read.parquet(f"{root}/kmeans_runs").orderBy("seq").collect()
    assert [e["status"] for e in events] == runs.STATES
    assert spark.read.parquet(result.tables["coordinates"]).count() == N
    labels = spark.read.parquet(result.tables["labels"])
    assert rows(labels, "topic_id", "topic_label") == [(1, "x"), (2, "x"), (3, "x")]
    assert seen == [["topic_id", "prompt"]]
    with pytest.raises(QualityError, match="exists already"):
        run_topics(items, cache, ids_of(items), root, k=3, as_of=NOW, run_id="r1")


def test_a_failed_fit_fails_the_run(spark, items, cache, tmp_path):
    nothing = spark.createDataFrame([("absent",)], "unified_id string")
    with pytest.raises(ValueError, match="no usable vectors"):
        run_topics(items, cache, nothing, str(tmp_path), k=3, as_of=NOW, run_id="r")
    state = runs.latest_runs(spark.read.parquet(f"{tmp_path}/kmeans_runs")).first()
    assert state["status"] == "failed" and "no usable vectors" in state["error_message"]


def test_a_failed_label_step_does_not_fail_the_run(spark, items, cache, tmp_path):
    def broken(prompts):
        raise RuntimeError("model is down")

    result = run_topics(items, cache, ids_of(items), str(tmp_path), k=2, as_of=NOW, run_id="r", skip_projection=True, labeller=broken)
    assert result.errors == {"labels": "model is down"} and "coordinates" not in result.tables
    state = runs.latest_runs(spark.read.parquet(f"{tmp_path}/kmeans_runs")).first()
    assert state["status"] == "completed" and "model is down" in state["error_message"]


def test_an_id_on_two_platforms_fails_the_run(spark, items, cache, tmp_path):
    with pytest.raises(QualityError, match="not unique"):
        run_topics(items.unionByName(items.limit(1)), cache, ids_of(items), str(tmp_path), k=2, as_of=NOW, run_id="r")


def test_run_ids(spark, items):
    ids = ids_of(items)
    assert new_run_id(ids, 3, NOW) == new_run_id(ids.repartition(7), 3, NOW) != new_run_id(ids.limit(3), 3, NOW)


def test_marts_keep_every_item(spark, items, cache, assignments):
    labels = topics.label_topics(assignments, "run", NOW)
    wide = marts.enriched_items(items, cache, NOW, None, assignments, labels, "run")
    assert wide.count() == N + 10 and wide.filter("topic_label is null").count() == 10
    general = marts.enriched_items(items, cache, NOW)
    assert rows(general.select("run_id", "processing_type", "keyword_list").distinct()) == [(None, "scheduled_general", [])]
    assert marts.topic_summary(assignments, labels).agg(F.sum("num_documents")).first()[0] == N


def test_a_length_is_computed_once_a_vector(spark):
    """Not once for each centre."""
    vectors = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [0.0, 2.0])], "unified_id string, embeddings array<double>")
    centers = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0])], "topic_id bigint, center array<double>")
    assigned = topics.assign_topics(vectors, centers)
    assert rows(assigned.select("unified_id", "topic_id", F.round("assignment_score", 9))) == [("a", 1, 0.2), ("b", 1, 0.0)]
    plan = assigned._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "/ sqrt" not in plan and "_length" not in plan
