"""The trend that a stream keeps."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from threadloom.operators.marts import sentiment_trend
from threadloom.streaming.trend import read_trend, trend_stream

SCHEMA = "run_id string, unified_id string, content_timestamp timestamp, source string, topic_id bigint, sentiment_score double, sentiment_magnitude double"


def said(i, day, source="a", topic=1, score=0.5):
    return ("r", f"u{i}", None if day is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=1), source, topic, score, 1.0)


def run(spark, folder, batches, checkpoint="checkpoint", delay="2 days"):
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    trend_stream(stream, f"{folder}/trend", f"{folder}/{checkpoint}", delay).awaitTermination()
    return rows(read_trend(spark, f"{folder}/trend"), "day", "source", "topic_id", "num_documents", "avg_sentiment_score", "sentiment_magnitude")


def whole(spark, batches):
    given = spark.createDataFrame([row for batch in batches for row in batch], SCHEMA).filter(F.col("content_timestamp").isNotNull())
    return rows(sentiment_trend(given), "day", "source", "topic_id", "num_documents", "avg_sentiment_score", "sentiment_magnitude")


BATCHES = [
    [said(1, 0), said(2, 0, topic=None), said(3, 0, source=None, score=None), said(4, 1)],
    [said(5, 2), said(6, 1, score=-1.0), said(7, 0)],  # the last two come late, within the delay
    [said(8, 3), said(8, 3), said(9, 2, topic=None), said(10, None)],
]


def test_equal_to_the_batch_trend_after_late_and_replayed_batches(spark, tmp_path):
    assert run(spark, tmp_path, BATCHES) == whole(spark, BATCHES)
    assert run(spark, tmp_path, [], checkpoint="lost") == whole(spark, BATCHES)  # all batches delivered again
    more = [[said(11, 3), said(12, 4)]]
    assert run(spark, tmp_path, more, checkpoint="lost") == whole(spark, BATCHES + more)


def test_what_comes_after_its_day_and_the_delay_is_not_counted(spark, tmp_path):
    batches = [[said(1, 0)], [said(2, 9)], [said(3, 10)], [said(4, 0), said(5, 10)]]
    assert run(spark, tmp_path, batches) == whole(spark, [*batches[:3], batches[3][1:]])


def test_only_touched_days_are_written(spark, tmp_path):
    run(spark, tmp_path, [[said(1, 0), said(2, 1)]])
    files = {p: p.stat().st_mtime_ns for p in tmp_path.glob("trend/day=2024-01-01/*.parquet")}
    run(spark, tmp_path, [[said(3, 1)]])
    assert files == {p: p.stat().st_mtime_ns for p in tmp_path.glob("trend/day=2024-01-01/*.parquet")}


def test_nothing(spark, tmp_path):
    assert run(spark, tmp_path, [[]]) == []
