"""Summary tables kept up to date by a stream."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import cut, discard

_KEYS = ["run_id", "day", "source", "topic_id"]
TREND = "run_id string, day date, source string, topic_id bigint, num_documents bigint, avg_sentiment_score double, sentiment_magnitude double"


def read_trend(spark: SparkSession, root: str) -> DataFrame:
    """The trend as it stands, or no rows before the first batch."""
    try:
        return spark.read.schema(TREND).parquet(root)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], TREND)
        raise


def _upsert(changed: DataFrame, root: str) -> None:
    """Put the changed rows in the place of those with their keys; only the days they are of are read and written again."""
    spark = changed.sparkSession
    days = [row[0] for row in changed.select("day").distinct().collect()]
    if not days:
        return
    same = reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in _KEYS])
    there = read_trend(spark, root).filter(F.col("day").isin(days))
    unchanged = there.alias("old").join(changed.select(_KEYS).alias("new"), same, "left_anti")
    whole = cut(unchanged.unionByName(changed))
    whole.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(root)
    discard(whole)


def trend_stream(assignments: DataFrame, root: str, checkpoint: str, delay: str = "2 days", available_now: bool = True):
    """Start a stream that keeps ``marts.sentiment_trend`` of the streamed ``assignments`` in a table partitioned by day.

    State holds one row per day, source and topic, and is forgotten ``delay`` after the day. Every batch gives the rows that
    changed, with their whole sums, and they replace the table's, so a batch that is delivered again changes nothing. A row
    that comes later than its day plus ``delay``, or has no time, is not counted; all others are, in whatever batch they come.
    The days a batch touches, a few within the delay, go through the driver as a filter of the table's partitions.
    """
    summed = assignments.withWatermark("content_timestamp", delay).groupBy(
        F.window("content_timestamp", "1 day").alias("_w"), "run_id", "source", "topic_id"
    ).agg(
        F.count(F.lit(1)).alias("num_documents"), F.avg("sentiment_score").alias("avg_sentiment_score"),
        F.sum("sentiment_magnitude").alias("sentiment_magnitude"),
    )
    rows = summed.withColumn("day", F.to_date("_w.start")).drop("_w")

    def write(batch: DataFrame, batch_id: int) -> None:
        changed = cut(batch)
        _upsert(changed, root)
        discard(changed)

    writer = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
