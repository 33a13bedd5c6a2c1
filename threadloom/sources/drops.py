"""File drops: JSON files, each one array of scraped posts, under ``<dataset_id>/<snapshot_id>.json``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_raw_json(spark: SparkSession, path: str | list[str], schema: str, streaming: bool = False) -> DataFrame:
    """One row per element of each file's array, plus ``file_path``.

    Works for a batch read and, with ``streaming``, as a file stream. A file is read by one task, so the number
    of files sets the parallelism.
    """
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    raw = reader.option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return raw.select("*", F.col("_metadata.file_path").alias("file_path"))


def below_root(file_path: Column, root: str) -> Column:
    """The path relative to ``root``, whatever scheme either is written with.

    The root counts at the start of the path only, or right after the host that a scheme puts before it.
    """
    bare_root = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:", "", root).strip("/") + "/"
    bare_path = F.regexp_replace(file_path, "^([A-Za-z][A-Za-z0-9+.-]*:)?/*", "")
    after_host = F.regexp_replace(bare_path, "^[^/]*/", "")
    below = lambda path: F.substr(path, F.lit(len(bare_root) + 1))
    hosted = file_path.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/]") & after_host.startswith(bare_root)
    return F.when(bare_path.startswith(bare_root), below(bare_path)).when(hosted, below(after_host)).otherwise(file_path)


def with_drop_metadata(df: DataFrame, path_col: str = "file_path", root: str = "") -> tuple[DataFrame, DataFrame]:
    """Add ``dataset_id`` (first segment) and ``snapshot_id`` (file name without ``.json``).

    Returns (accepted, rejected); a path of fewer than two segments is rejected.
    """
    relative = below_root(F.col(path_col), root) if root else F.col(path_col)
    parts = F.split(relative, "/")
    tagged = df.withColumn("_parts", parts)
    accepted = (
        tagged.filter(F.size("_parts") >= 2)
        .withColumn("dataset_id", F.element_at("_parts", 1))
        .withColumn("snapshot_id", F.regexp_replace(F.element_at("_parts", -1), r"\.json$", ""))
        .drop("_parts")
    )
    rejected = (
        tagged.filter(F.coalesce(F.size("_parts") < 2, F.lit(True)))
        .withColumn("reject_reason", F.lit("path_too_short"))
        .drop("_parts")
    )
    return accepted, rejected
