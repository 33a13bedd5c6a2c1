"""Checks for what Spark does not enforce: keys, required columns, value rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A table breaks a rule it must satisfy."""


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raise when a key occurs twice."""
    double = check_unique(df, keys).take(1)
    if double:
        raise QualityError(f"{what}: {', '.join(keys)} is not unique, for example {double[0].asDict()}")


def unique_or_fail(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df`` unchanged, failing at run time when ``key`` repeats.

    The check groups by the key its consumer joins on, so it adds no shuffle to that join.
    """
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    message = F.concat(F.lit(f"{what}: {key} is not unique: "), F.col(key))
    checked = grouped.filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(key, "_row.*").select(*df.columns)


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, n_nulls) of the required columns, counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.unpivot([], cols, "column_name", "n_nulls")


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n_broken) in one pass. A rule holds when its expression is true or unknown."""
    counted = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(True))).alias(name) for name, rule in rules.items()])
    return counted.unpivot([], list(rules), "rule", "n_broken")


def broken_rules(rules: dict[str, Column]) -> Column:
    """The names of the rules a row breaks."""
    names = [F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]
    return F.filter(F.array(*names), lambda n: n.isNotNull())


def score_rules(sentiment: str = "sentiment_score", magnitude: str = "sentiment_magnitude") -> dict[str, Column]:
    """Sentiment lies in -1..1 and its magnitude is not negative."""
    return {
        "sentiment_in_range": F.col(sentiment).between(-1, 1),
        "magnitude_not_negative": F.col(magnitude) >= 0,
    }


def label_rules() -> dict[str, Column]:
    """Confidence lies in 0..1."""
    return {"confidence_in_range": F.col("confidence_score").between(0, 1)}


def required(cols: list[str]) -> dict[str, Column]:
    return {f"{c}_present": F.col(c).isNotNull() for c in cols}
