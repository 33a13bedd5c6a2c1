"""Continuous ingest with Structured Streaming: file drops in, checked raw tables out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.quality import required
from threadloom.operators.sinks import SUCCESS, append_checked
from threadloom.schemas import DATASET_PLATFORMS, QUORA_WIRE, REDDIT_WIRE, REQUIRED
from threadloom.sources.drops import below_root, with_drop_metadata
from threadloom.sources.envelopes import decode_envelopes
from threadloom.sources.normalize import normalize_quora, normalize_reddit
from threadloom.sources.routing import route
from threadloom.session import cut, discard

_WIRE = {"Reddit": (REDDIT_WIRE, normalize_reddit), "Quora": (QUORA_WIRE, normalize_quora)}
_LOG = "batch_id bigint, status string, enrichment_error string"
REJECTS = "file_path string, dataset_id string, reject_reason string"


def dataset_folders(platform: str, mapping: dict[str, str] | None = None) -> list[str]:
    """The folders below the drop root that belong to a platform."""
    return sorted(dataset for dataset, owner in (mapping or DATASET_PLATFORMS).items() if owner == platform)


def ingest_stream(
    spark: SparkSession, drop_root: str, platform: str, table_path: str, checkpoint: str, stream: str,
    rules: dict[str, Column] | None = None, on_success: Callable[[int], None] | None = None,
    files_per_batch: int | None = None, available_now: bool = True, most_batches: int | None = None,
):
    """Start a stream that normalises one platform's dropped files into the table at ``table_path``.

    Only files below the platform's dataset folders are parsed; the filter on their paths is settled before a file is
    opened. What lies elsewhere is for :func:`reject_stream`. A batch is written to its own folder, named by ``stream``
    and batch id, so a batch that is delivered again replaces itself. ``on_success`` (the enrichment step) runs after a
    batch without rejected rows; its error is logged and does not undo the batch.

    ``files_per_batch`` bounds a batch. Every batch has a price of its own, so with ``most_batches`` a backlog that would take
    more batches than that is taken in as many, of more files each.
    """
    if files_per_batch is not None and most_batches is not None:
        files_per_batch = max(files_per_batch, -(-_files_below(spark, drop_root) // most_batches))
    wire, normalize = _WIRE[platform]
    reader = spark.readStream.schema(wire).option("multiLine", True).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    own = F.substring_index(below_root(F.col("_metadata.file_path"), drop_root), "/", 1).isin(dataset_folders(platform))
    raw = reader.json(drop_root).filter(own).select("*", F.col("_metadata.file_path").alias("file_path"))
    checks = {**required(REQUIRED["reddit_data"]), **(rules or {})}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        accepted, _ = with_drop_metadata(batch, root=drop_root)
        folder = f"stream={stream}/batch_id={batch_id}"
        status = append_checked(normalize(accepted), f"{table_path}/{folder}", checks, mode="overwrite")
        error = _follow(status, on_success, batch_id)
        row = [(batch_id, status, error)]
        batch.sparkSession.createDataFrame(row, _LOG).coalesce(1).write.mode("overwrite").parquet(f"{table_path}_log/{folder}")

    writer = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", f"{checkpoint}/{stream}")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _files_below(spark: SparkSession, root: str) -> int:
    """How many files lie below ``root``. Only their names are listed."""
    return len(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).inputFiles())


def _follow(status: str, on_success: Callable[[int], None] | None, batch_id: int) -> str | None:
    if status != SUCCESS or on_success is None:
        return None
    try:
        on_success(batch_id)
    except Exception as failure:  # recorded by the caller; the batch itself stays
        return str(failure)
    return None


def rejected_drops(paths: DataFrame, drop_root: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """(file_path, dataset_id, reject_reason) of dropped files that no platform takes."""
    accepted, short = with_drop_metadata(paths, root=drop_root)
    unknown = route(accepted, mapping).filter(F.col("reject_reason").isNotNull())
    none = F.lit(None).cast("string").alias("dataset_id")
    return unknown.select("file_path", "dataset_id", "reject_reason").unionByName(short.select("file_path", none, "reject_reason"))


def reject_stream(spark: SparkSession, drop_root: str, table_path: str, checkpoint: str, stream: str, available_now: bool = True):
    """Start a stream that stores the dropped files no platform takes. Only paths are read, no file is opened."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    paths = files.option("recursiveFileLookup", True).load(drop_root).select(F.col("path").alias("file_path"))
    writer = (
        rejected_drops(paths, drop_root).writeStream.format("parquet").option("path", table_path)
        .option("checkpointLocation", f"{checkpoint}/{stream}")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def ingest_messages(
    messages: DataFrame, table_path: str, batch: str, rules: dict[str, Column] | None = None,
    on_success: Callable[[str], None] | None = None,
) -> dict[str, str]:
    """Store a batch of pushed messages, ``messages(data, attributes)``; returns the insert status per platform.

    Messages are routed by their dataset id first, so each platform's payload is parsed with its own schema. The posts
    of a platform go to ``table_path/<platform>/batch=<batch>``; messages that cannot be decoded and those of unknown
    datasets go to ``table_path/rejects/batch=<batch>`` with their reason. A batch that comes again replaces itself.
    ``on_success`` runs if every row of the batch kept the rules.
    """
    routed = route(messages.withColumn("dataset_id", F.try_element_at("attributes", F.lit("dataset_id"))))
    lost = routed.filter(F.col("reject_reason").isNotNull()).select("dataset_id", "reject_reason", "data")
    statuses = {}
    for platform, (wire, normalize) in _WIRE.items():
        own = routed.filter(F.col("platform") == platform).select("data", "attributes")
        accepted, rejected = decode_envelopes(own.withColumn("message", F.col("data")), wire)
        lost = lost.unionByName(rejected.select("dataset_id", "reject_reason", F.col("message").alias("data")))
        checks = {**required(REQUIRED["reddit_data"]), **(rules or {})}
        rows = normalize(accepted.drop("message"))
        statuses[platform] = append_checked(rows, f"{table_path}/{platform}/batch={batch}", checks, mode="overwrite")
    lost.write.mode("overwrite").parquet(f"{table_path}/rejects/batch={batch}")
    if on_success is not None and all(status == SUCCESS for status in statuses.values()):
        on_success(batch)
    return statuses


def read_ingested(spark: SparkSession, table_path: str, outcome: str = "accepted") -> DataFrame:
    """The accepted rows of all batches."""
    rows = spark.read.parquet(table_path).filter(F.col("outcome") == outcome)
    return rows.drop("stream", "batch_id", "outcome", *(["failed_rules"] if outcome == "accepted" else []))


def dedupe_stream(stream: DataFrame, keys: list[str], at: str, delay: str = "2 days") -> DataFrame:
    """Drop repeats of a key that arrive within ``delay``; state older than that is forgotten."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def dedupe_with_late(
    stream: DataFrame, keys: list[str], at: str, delay: dt.timedelta, root: str, checkpoint: str, available_now: bool = True,
):
    """Start a stream that keeps one row per key, forgets keys with time, and stores what comes too late beside the result.

    The mark of a batch is the greatest time in earlier batches, less ``delay``. Rows older than the mark, and rows without a
    time, go to ``root/late``. Of the others the earliest of each key (null is a key too) goes to ``root/kept``, unless a row
    of the key was kept whose time plus ``delay`` has not passed the mark. The kept rows are the state: a batch reads the keys
    of the last two delays, by days and row groups, and nothing older. A batch that is delivered again replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = F.col("batch_id") < batch_id
        seen = _rows_before(spark, f"{root}/marks", "seen timestamp", before)
        last = seen.agg(F.max("seen")).first()[0]
        mark = F.lit(None).cast("timestamp") if last is None else F.lit(last - delay).cast("timestamp")
        rows = cut(batch.withColumn("_late", F.col(at).isNull() | F.coalesce(F.col(at) < mark, F.lit(False))))
        rows.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{root}/late/batch_id={batch_id}")
        timely = rows.filter("NOT _late").drop("_late")
        first = timely.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*batch.columns), at).alias("_row"))
        kept = _rows_before(spark, f"{root}/kept", f"{batch.schema.simpleString()[7:-1].replace(':', ' ')}, day date", before)
        if last is not None:
            limit = last - 2 * delay
            kept = kept.filter((F.col("day") >= F.lit(limit.date())) & (F.col(at) >= F.lit(limit)))
        known = kept.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)])
        same = reduce(lambda a, b: a & b, [F.col(f"_k{i}").eqNullSafe(F.col(f"_s{i}")) for i in range(len(keys))])
        fresh = first.join(known, same, "left_anti").select("_row.*").withColumn("day", F.to_date(at))
        fresh.write.mode("overwrite").partitionBy("day").parquet(f"{root}/kept/batch_id={batch_id}")
        timely.agg(F.max(at).alias("seen")).write.mode("overwrite").parquet(f"{root}/marks/batch_id={batch_id}")
        discard(rows)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _rows_before(spark: SparkSession, path: str, schema: str, before: Column) -> DataFrame:
    """Rows of earlier batches, or none if there are none yet."""
    declared = f"{schema}, batch_id bigint"
    try:
        return spark.read.schema(declared).parquet(path).filter(before)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], declared)
        raise
