"""Keep-first merge into a cache table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.quality import unique_or_fail
from threadloom.session import cut, discard


def _present(df: DataFrame, col: str, side: str) -> Column:
    """The column, with an empty array counted as missing so that a later result can fill it."""
    value = F.col(f"{side}.{col}")
    if df.schema[col].dataType.typeName() == "array":
        return F.when(F.size(value) > 0, value)
    return value


def merge_keep_first(target: DataFrame, source: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Insert new keys; for known keys fill only what is missing. A key twice in ``source`` fails the job."""
    checked = unique_or_fail(source.select(key, *cols), key, "merge source")
    joined = target.alias("t").join(checked.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    return joined.select(
        F.coalesce(f"t.{key}", f"s.{key}").alias(key),
        *[F.coalesce(_present(target, c, "t"), _present(source, c, "s")).alias(c) for c in cols],
    )


# A cache is a Parquet table partitioned by ``part``, a hash of the key, and bucketed by the key within each part.
DATABASE = "threadloom_tables"
# Parts are what a merge rewrites, buckets what a task of it reads; both grow with the table, and are the caller's choice.
PARTS, BUCKETS = 8, 4


def part_of(key: str, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _stored(spark: SparkSession, root: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def read_current(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of the cache at ``root``, or an empty table before the first merge."""
    found = _stored(spark, root, schema)
    return spark.createDataFrame([], schema) if found is None else found.drop("part")


def cache_table(spark: SparkSession, root: str, key: str, schema: str, buckets: int = BUCKETS) -> DataFrame:
    """The cache at ``root`` as a table whose layout Spark knows; one that another session made is found again by its files."""
    name = f"{DATABASE}.at_{hashlib.md5(root.encode()).hexdigest()}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({schema}, part int) USING parquet PARTITIONED BY (part) "
            f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{root}'"
        )
        if _stored(spark, root, schema) is not None:
            spark.catalog.recoverPartitions(name)
    table = spark.table(name)
    table.table_name = name
    return table


def merged_parts(source: DataFrame, target: DataFrame, key: str, cols: list[str], touched: list[int], buckets: int = BUCKETS) -> DataFrame:
    """The rows of the touched parts of ``target``, a :func:`cache_table`, after the merge.

    Only ``source`` is shuffled, once and into the table's buckets, so the check of its keys and the join find it in place.
    """
    return merge_keep_first(target.filter(F.col("part").isin(touched)), source.repartition(buckets, key), key, cols)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The setting for one statement; inserting into a table takes no such option of its own."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def merge_into(
    source: DataFrame, root: str, key: str, cols: list[str], schema: str, flags: dict[str, str] | None = None,
    parts: int = PARTS, buckets: int = BUCKETS,
) -> list[int]:
    """Merge ``source`` into the cache at ``root`` by :func:`merge_keep_first`; returns the parts that were written.

    Only parts that hold a key of ``source`` are read and written again, by a dynamic partition overwrite: the new files
    take the old ones' place when the whole job has succeeded. ``flags`` adds columns that tell whether an array is filled,
    for readers that need no more. ``schema``, ``flags``, ``parts`` and ``buckets`` stay as they were at the first merge. One
    job writes a cache at a time; of two at once the later one's parts win. An empty ``source`` changes nothing.
    """
    spark = source.sparkSession
    declared = ", ".join([schema, *[f"{flag} boolean" for flag in flags or {}]])
    target = cache_table(spark, root, key, declared, buckets)
    source = cut(source)
    touched = sorted(row[0] for row in source.select(part_of(key, parts)).distinct().collect())
    if touched:
        merged = merged_parts(source, target, key, cols, touched, buckets)
        for flag, column in (flags or {}).items():
            merged = merged.withColumn(flag, F.coalesce(F.size(column) > 0, F.lit(False)))
        rows = merged.withColumn("part", part_of(key, parts)).select(target.columns)
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.write.mode("overwrite").insertInto(target.table_name)
    discard(source)
    return touched
