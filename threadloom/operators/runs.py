"""Run registry and watermarks: append-only rows, newest wins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.skew import skew_join

# The states of a run, in order, and the state after an error.
STATES = ["submitted", "model_created", "prediction_started", "prediction_completed", "completed"]
FAILED = "failed"

RUN_ATTRIBUTES = {
    "num_topics": "bigint", "description": "string", "model_name": "string", "model_creation_job_id": "string",
    "predict_job_id": "string", "labeling_job_id": "string", "error_message": "string", "embedding_model": "string",
}
RUN_EVENTS = "run_id string, seq bigint, at timestamp, status string, " + ", ".join(
    f"{name} {type_}" for name, type_ in RUN_ATTRIBUTES.items()
)
EPOCH = dt.datetime(1970, 1, 1)


def record_run(spark: SparkSession, path: str, run_id: str, seq: int, status: str, at: dt.datetime, **attributes) -> None:
    """Append one event of a run: its registration, a change of state, or a failure."""
    unknown = set(attributes) - set(RUN_ATTRIBUTES)
    if unknown:
        raise ValueError(f"unknown run attributes: {sorted(unknown)}")
    row = (run_id, seq, at, status, *[attributes.get(name) for name in RUN_ATTRIBUTES])
    spark.createDataFrame([row], RUN_EVENTS).coalesce(1).write.mode("append").parquet(path)


def latest_runs(events: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    """One row per run: creation time, newest status, and each attribute's newest set value.

    All aggregates combine before the shuffle, so a run with very many events costs one row per task.
    """
    order = F.struct("at", "seq")

    def newest(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), order)).alias(name)

    names = list(RUN_ATTRIBUTES) if attributes is None else attributes
    return events.groupBy("run_id").agg(
        F.min("at").alias("created_at"), F.max_by("status", order).alias("status"), *[newest(n) for n in names]
    )


def advance_watermark(spark: SparkSession, path: str, table_name: str, processed_to: dt.datetime, at: dt.datetime) -> None:
    """Record how far a table has been processed. Call it only after the results are written."""
    schema = "table_name string, last_processed_timestamp timestamp, updated_at timestamp"
    spark.createDataFrame([(table_name, processed_to, at)], schema).coalesce(1).write.mode("append").parquet(path)


def current_watermarks(marks: DataFrame) -> DataFrame:
    """One row per table; a mark never moves back."""
    return marks.groupBy("table_name").agg(
        F.max("last_processed_timestamp").alias("last_processed_timestamp"), F.max("updated_at").alias("updated_at")
    )


def read_watermark(marks: DataFrame, table_name: str) -> dt.datetime:
    """The table's mark, or the epoch: without one everything is still to be processed."""
    found = current_watermarks(marks).filter(F.col("table_name") == table_name).take(1)
    return found[0]["last_processed_timestamp"] if found else EPOCH


def incremental(df: DataFrame, ts_col: str, mark: dt.datetime | Column) -> DataFrame:
    """Rows newer than the mark; the filter reaches the scan."""
    limit = mark if isinstance(mark, Column) else F.lit(mark)
    return df.filter(F.col(ts_col) > limit)


def not_yet_done(df: DataFrame, ts_col: str, key: str, mark: dt.datetime, done: DataFrame, overlap: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    """Rows from ``overlap`` before the mark on whose ``key`` is not in ``done(key, ts_col)``; each comes exactly once.

    The mark alone would lose rows that arrive later with the marked time, or a little before it. Both sides are read from
    that time on only, and a key that is done is done for all its rows. Rows that arrive later than the overlap are lost.
    """
    since = F.col(ts_col) >= F.lit(mark - overlap)
    return skew_join(df.filter(since), done.filter(since).select(key).distinct(), key, "left_anti")
