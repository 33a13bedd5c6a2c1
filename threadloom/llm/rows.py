"""Keeping and dropping whole rows whose extra columns are not known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import cut


def wrap(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every row as one struct ``_row``, beside ``_<name>`` for the columns an operator reads: no name can clash."""
    return df.select(F.struct("*").alias("_row"), *[F.col(c).alias(f"_{c}") for c in columns])


def restore(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def text_hash(text: str = "_text"):
    """Tells rows under one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.col(text).isNull())


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` that ``decided(_doc_id, _th, _kept)``, one row for each of them, keeps.

    ``_th`` is :func:`text_hash`. Rows alike in id and text are told apart by nothing that matters, so of those kept
    under one id and text exactly one leaves; it is picked in a small aggregate over such rows alone.
    """
    keys = cut(decided.groupBy("_doc_id", "_th").agg(F.max("_kept").alias("_kept"), F.count(F.lit(1)).alias("_rows")))
    keyed = wrap(docs, ["doc_id", "text"]).withColumn("_th", text_hash())
    kept = _matching(keyed, keys.filter(~F.col("_kept") | (F.col("_rows") > 1)), "left_anti")
    repeated = keys.filter(F.col("_kept") & (F.col("_rows") > 1))
    out = restore(kept)
    if not repeated.isEmpty():
        alike = _matching(keyed, repeated, "left_semi").groupBy("_doc_id", "_th").agg(F.any_value("_row").alias("_row"))
        out = out.unionByName(restore(alike))
    return out


def _matching(keyed: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    right = keys.select(F.col("_doc_id").alias("_id"), F.col("_th").alias("_h"), F.xxhash64("_doc_id", "_th").alias("_kh"))
    left = keyed.withColumn("_lh", F.xxhash64("_doc_id", "_th"))
    same = F.col("_doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_h")) & (F.col("_lh") == F.col("_kh"))
    return left.join(right, same, how)
