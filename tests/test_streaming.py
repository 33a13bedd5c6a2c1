import base64
import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import rows
from threadloom.schemas import QUORA_DATASET_ID, REDDIT_DATASET_ID, REDDIT_WIRE
from threadloom.sources.drops import read_raw_json
from threadloom.sources.normalize import normalize_reddit
from threadloom.operators.runs import not_yet_done
from threadloom.operators.sinks import read_checked
from threadloom.streaming.ingest import dedupe_stream, dedupe_with_late, ingest_messages, ingest_stream, read_ingested, reject_stream


def drop(root, name, posts):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(posts))


def run(spark, tmp_path, checkpoint="checkpoints", **options):
    query = ingest_stream(
        spark, str(tmp_path / "drops"), "Reddit", str(tmp_path / "reddit_data"), str(tmp_path / checkpoint), "s", **options
    )
    query.awaitTermination()
    return read_ingested(spark, str(tmp_path / "reddit_data"))


def log(spark, tmp_path):
    return spark.read.parquet(str(tmp_path / "reddit_data_log")).orderBy("batch_id").collect()


def test_stream_equals_batch_and_takes_new_files_only(spark, tmp_path):
    drop(tmp_path / "drops", f"{REDDIT_DATASET_ID}/s_1.json", [{"post_id": "a", "num_upvotes": "3"}, {"post_id": "b"}])
    drop(tmp_path / "drops", f"{QUORA_DATASET_ID}/s_2.json", [{"post_id": "q"}])
    drop(tmp_path / "drops", "stray.json", [{"post_id": "x"}])
    first = run(spark, tmp_path)
    assert rows(first, "post_id", "snapshot_id") == [("a", "s_1"), ("b", "s_1")]
    drop(tmp_path / "drops", f"{REDDIT_DATASET_ID}/s_3.json", [{"post_id": "c"}])
    both = run(spark, tmp_path)
    batch = normalize_reddit(
        read_raw_json(spark, str(tmp_path / "drops" / REDDIT_DATASET_ID), REDDIT_WIRE).withColumn(
            "snapshot_id", F.regexp_extract("file_path", r"(s_\d)", 1)
        )
    )
    assert rows(both, *batch.columns) == rows(batch)
    assert [r["status"] for r in log(spark, tmp_path)] == ["completed_success", "completed_success"]


def test_files_that_no_platform_takes_are_stored(spark, tmp_path):
    drop(tmp_path / "drops", f"{REDDIT_DATASET_ID}/s_1.json", [{"post_id": "a"}])
    drop(tmp_path / "drops", "gd_unknown/s_2.json", [{"post_id": "q"}])
    drop(tmp_path / "drops", "stray.json", [{"post_id": "x"}])
    for _ in range(2):  # a second run finds nothing new
        reject_stream(spark, str(tmp_path / "drops"), str(tmp_path / "rejects"), str(tmp_path / "checkpoints"), "r").awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "rejects"))
    assert rows(kept, "dataset_id", "reject_reason") == [("gd_unknown", "unknown_dataset_id"), (None, "path_too_short")]


def test_messages(spark, tmp_path):
    def message(dataset, posts, job="j"):
        return (base64.b64encode(json.dumps(posts).encode()).decode(), {"dataset_id": dataset, "job_id": job})

    given = [message(REDDIT_DATASET_ID, [{"post_id": "a"}, {"post_id": "b"}]), message(QUORA_DATASET_ID, [{"post_id": "q"}]),
             message("gd_unknown", [{"post_id": "x"}]), ("***", {"dataset_id": REDDIT_DATASET_ID, "job_id": "j"})]
    messages = spark.createDataFrame(given, "data string, attributes map<string, string>")
    calls = []
    for _ in range(2):  # delivered twice
        status = ingest_messages(messages, str(tmp_path / "raw"), "b1", on_success=calls.append)
    assert set(status.values()) == {"completed_success"} and calls == ["b1", "b1"]
    stored = {p: rows(read_checked(spark, str(tmp_path / "raw" / p)), "post_id") for p in ("Reddit", "Quora")}
    assert stored == {"Reddit": [("a",), ("b",)], "Quora": [("q",)]}
    assert rows(spark.read.parquet(str(tmp_path / "raw" / "rejects")), "reject_reason") == [("bad_base64",), ("unknown_dataset_id",)]


def test_a_replayed_stream_replaces_its_batches(spark, tmp_path):
    for i in range(3):
        drop(tmp_path / "drops", f"{REDDIT_DATASET_ID}/s_{i}.json", [{"post_id": f"p{i}"}])
    once = rows(run(spark, tmp_path, files_per_batch=1), "post_id")
    again = rows(run(spark, tmp_path, checkpoint="lost", files_per_batch=1), "post_id")
    assert once == again == [("p0",), ("p1",), ("p2",)]


def test_enrichment_follows_success_and_its_error_is_kept_apart(spark, tmp_path):
    drop(tmp_path / "drops", f"{REDDIT_DATASET_ID}/s_1.json", [{"post_id": "a"}])
    calls = []

    def fail(batch_id):
        calls.append(batch_id)
        raise RuntimeError("no quota")

    assert run(spark, tmp_path, on_success=fail).count() == 1
    assert calls == [0] and log(spark, tmp_path)[0]["enrichment_error"] == "no quota"


def test_rejected_rows_hold_back_enrichment(spark, tmp_path):
    drop(tmp_path / "drops", f"{REDDIT_DATASET_ID}/s_1.json", [{"post_id": "a"}, {"title": "no id"}])
    calls = []
    kept = run(spark, tmp_path, rules={"id": F.col("post_id").isNotNull()}, on_success=calls.append)
    assert rows(kept, "post_id") == [("a",)] and calls == []
    assert log(spark, tmp_path)[0]["status"] == "completed_with_failures"
    assert read_ingested(spark, str(tmp_path / "reddit_data"), "rejected").first()["failed_rules"] == ["id"]


def test_dedupe_stream(spark, tmp_path):
    df = spark.range(50).selectExpr("id % 10 as k", "timestamp_seconds(1704067200 + id) as at")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = dedupe_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["k"], "at")
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "k") == [(i,) for i in range(10)]


def test_expiry_and_late_rows(spark, tmp_path):
    root, day = str(tmp_path / "once"), lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    batches = [
        [("a", day(0)), ("a", day(1)), (None, day(1)), ("b", day(2)), ("t", None)],
        [("a", day(3)), ("b", day(3)), (None, day(2)), ("c", day(9))],  # repeats within the delay
        [("d", day(4)), ("c", day(8)), ("e", day(12))],  # d is older than the mark, day 6
        [("a", day(13)), ("c", day(14))],  # a is forgotten, c is not
    ]
    schema = "k string, at timestamp"
    for given in batches:
        spark.createDataFrame(given, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        dedupe_with_late(stream, ["k"], "at", dt.timedelta(days=3), root, f"{root}/checkpoint").awaitTermination()
    kept = spark.read.parquet(f"{root}/kept").select("k", "at").collect()
    assert sorted(((r["k"], r["at"]) for r in kept), key=repr) == sorted(
        [("a", day(0)), (None, day(1)), ("b", day(2)), ("c", day(9)), ("e", day(12)), ("a", day(13))], key=repr
    )
    assert rows(spark.read.parquet(f"{root}/late"), "k") == [("d",), ("t",)]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    dedupe_with_late(stream, ["k"], "at", dt.timedelta(days=3), root, f"{root}/other").awaitTermination()  # all again from the start
    assert len(spark.read.parquet(f"{root}/kept").collect()) == len(kept)


def test_rows_at_the_mark_come_once(spark):
    at = dt.datetime(2024, 1, 5)
    first = spark.createDataFrame([(1, at), (2, at - dt.timedelta(days=9))], "id long, at timestamp")
    then = first.unionByName(spark.createDataFrame([(3, at), (4, at - dt.timedelta(hours=1)), (5, at - dt.timedelta(days=9))], first.schema))
    assert rows(not_yet_done(then, "at", "id", at, first), "id") == [(3,)]
    found = not_yet_done(then, "at", "id", at, first, dt.timedelta(days=1))
    assert rows(found, "id") == [(3,), (4,)]
    assert not_yet_done(then, "at", "id", at, first.unionByName(found), dt.timedelta(days=1)).count() == 0


def test_a_backlog_takes_a_bounded_number_of_batches(spark, tmp_path):
    for number in range(7):
        drop(tmp_path / "drops", f"{REDDIT_DATASET_ID}/s_{number}.json", [{"post_id": f"p{number}"}])
    taken = run(spark, tmp_path, files_per_batch=1, most_batches=2)
    assert sorted(r.post_id for r in taken.collect()) == [f"p{n}" for n in range(7)] and len(log(spark, tmp_path)) == 2
    drop(tmp_path / "drops", f"{REDDIT_DATASET_ID}/s_7.json", [{"post_id": "p7"}])
    assert run(spark, tmp_path, files_per_batch=1, most_batches=2).count() == 8


def test_late_query_writes_its_batches_by_several_tasks(spark, sf, tmp_path, monkeypatch):
    from threadloom.catalog import jobs

    monkeypatch.setattr(jobs, "run_dir", lambda spark, name: str(tmp_path))
    jobs.streamed_with_late(spark, sf).count()
    batches = spark.read.parquet(str(tmp_path / "marks")).select("batch_id").distinct().count()
    assert len(list((tmp_path / "in").glob("*.parquet"))) > batches > 3
