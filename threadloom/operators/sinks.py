"""Writing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.quality import QualityError, broken_rules, check_not_null, require_unique
from threadloom.schemas import DECLARED, LAYOUTS, PRIMARY_KEYS, REQUIRED, fields

# Outcome of an insert.
SUCCESS = "completed_success"
WITH_FAILURES = "completed_with_failures"


def append_checked(df: DataFrame, path: str, rules: dict[str, Column], mode: str = "append") -> str:
    """Append in one pass: rows that keep all rules under ``outcome=accepted``, others under ``outcome=rejected``.

    Returns the insert status, from a count taken during the write.
    """
    outcome = F.when(F.size("failed_rules") == 0, "accepted").otherwise("rejected")
    checked = df.withColumn("failed_rules", broken_rules(rules)).withColumn("outcome", outcome)
    seen = Observation()
    (
        checked.observe(seen, F.count_if(F.col("outcome") == "rejected").alias("rejected"))
        .write.mode(mode)
        .partitionBy("outcome")
        .parquet(path)
    )
    return WITH_FAILURES if seen.get["rejected"] else SUCCESS


def read_checked(spark: SparkSession, path: str, outcome: str = "accepted", schema: str | None = None) -> DataFrame:
    """The accepted (or rejected) rows of a table written by :func:`append_checked`; a given ``schema`` is not inferred."""
    reader = spark.read.schema(f"{schema}, failed_rules array<string>, outcome string") if schema else spark.read
    rows = reader.parquet(path).filter(F.col("outcome") == outcome).drop("outcome")
    return rows.drop("failed_rules") if outcome == "accepted" else rows


def write_clustered(df: DataFrame, path: str, date_col: str, cluster_cols: list[str], mode: str = "append") -> None:
    """One folder per day, rows sorted by the cluster columns so row groups can be skipped.

    Rebalancing by day writes small days as one file and cuts a day with very many rows into several.
    """
    order = ["day", *cluster_cols]
    dated = df.withColumn("day", F.to_date(date_col)).hint("rebalance", "day")
    dated.sortWithinPartitions(*order).write.mode(mode).partitionBy("day").parquet(path)


def write_table(df: DataFrame, root: str, table: str, mode: str = "append") -> str:
    """Write one of the partitioned tables in its declared layout below ``root``; returns its path."""
    date_col, cluster_cols = LAYOUTS[table]
    path = f"{root}/{table}"
    write_clustered(df, path, date_col, cluster_cols, mode)
    return path


def write_declared(df: DataFrame, root: str, table: str, mode: str = "append") -> str:
    """Like :func:`write_table`, with the columns and types of the table's declared schema.

    Its primary key must be unique in ``df`` and its required columns set, or nothing is written. ``df`` is read for the
    checks too, so hand in a written table where it is costly.
    """
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in fields(DECLARED[table])])
    if table in PRIMARY_KEYS:
        require_unique(rows, PRIMARY_KEYS[table], table)
    missing = [r["column_name"] for r in check_not_null(rows, REQUIRED.get(table, [])).filter("n_nulls > 0").collect()] if table in REQUIRED else []
    if missing:
        raise QualityError(f"{table}: {', '.join(missing)} must be set")
    return write_table(rows, root, table, mode)
