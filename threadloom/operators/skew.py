"""Equi-joins whose left side may be dominated by a few keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def skew_join(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Join on ``key`` (one column or several) such that adaptive execution can split a key with very many left rows.

    Spark splits a skewed partition only if both inputs come straight from a shuffle. A right side that was just
    aggregated or ranked by ``key`` would be joined in place, so the hash of the key is added as a second join
    key: both sides are then shuffled for this join, large partitions are cut into pieces, and a small right side
    is still broadcast once its size is known.
    """
    keys = [key] if isinstance(key, str) else key
    hashed = F.xxhash64(*keys)
    return left.withColumn("_kh", hashed).join(right.withColumn("_kh", hashed), [*keys, "_kh"], how).drop("_kh")


# A key with more rows than this is dealt over several tasks.
FLOOR = 100_000


def hot_keys(counts: DataFrame, key: str, floor: int = FLOOR) -> DataFrame:
    """(key, _salts) for every key of ``counts(key, n)`` with more than ``floor`` rows, whatever their number."""
    return (
        counts.groupBy(key)
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > floor)
        .select(key, F.ceil(F.col("n") / floor).cast("int").alias("_salts"))
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_key: str,
    counts: DataFrame,
    how: str = "inner",
    floor: int = FLOOR,
) -> DataFrame:
    """Join on ``key`` with the rows of each hot key dealt over several tasks by the hash of ``row_key``.

    ``counts(key, n)`` gives (an upper bound of) the left rows per key. Only the right rows of hot keys are
    repeated, once per salt, so no task gets more than about ``floor`` rows of a key. The table of hot keys has at most
    one row per ``floor`` rows; Spark broadcasts it if it is small and joins it otherwise.
    """
    hot = hot_keys(counts, key, floor)
    salted_left = (
        skew_join(left, hot, key, "left")
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(row_key), F.col("_salts")).cast("int"), F.lit(0)))
        .drop("_salts")
    )
    salted_right = (
        skew_join(right, hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
