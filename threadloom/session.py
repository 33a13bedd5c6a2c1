"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def get_session(app: str = "threadloom", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else made."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
        folder = tempfile.mkdtemp(prefix="threadloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return os.path.join(shared_dir(spark), "threadloom", f"{name}-{uuid.uuid4().hex}")


def scratch(spark: SparkSession) -> str:
    """The database of this application's intermediate tables: other applications on the same metastore have their own."""
    return "threadloom_scratch_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    A lost executor then costs no recomputation, and the next plan starts from a scan of known size. The tables belong to
    the application's own database below the shared folder; :func:`discard` drops one, :func:`discard_all` all of them.
    """
    spark = df.sparkSession
    database = scratch(spark)
    folder = os.path.join(shared_dir(spark), "threadloom", "cuts", database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    name = f"{database}.cut_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(name)
    table = spark.table(name)
    table.cut_name = name
    return table


def discard(*frames: DataFrame) -> None:
    """Drop the tables that :func:`cut` wrote for these frames; nothing may read them afterwards."""
    for frame in frames:
        frame.sparkSession.sql(f"DROP TABLE IF EXISTS {frame.cut_name}")


def discard_all(spark: SparkSession) -> None:
    """Drop every table that :func:`cut` wrote in this application, once all results that read them are stored."""
    spark.sql(f"DROP DATABASE IF EXISTS {scratch(spark)} CASCADE")


def pin(df: DataFrame) -> DataFrame:
    """Like :func:`cut`, keeping the partitions and the order of rows as they are."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
