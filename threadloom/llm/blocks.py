"""Comparing rows that share a key, in blocks of bounded size, however many rows a key has."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.skew import skew_join


def deal(rows: DataFrame, key: str, item: str, block: int, sums: dict[str, Column] | None = None, only: Column | None = None) -> DataFrame:
    """Rows with ``_i``, ``_j`` and ``_part``, so that any two rows of a key share exactly one (key, _i, _j).

    A key of at most ``block`` rows keeps them in (0, 0). A larger one is cut by the hash of ``item`` into parts of
    about ``block`` rows, and every pair of parts (i <= j) becomes a place of its own: that of the parts of two rows.
    A row of a key with c parts is sent c times. Keys are left out for which ``only`` is not true; it may use ``_rows``
    (rows of the key, above 1 by default) and the aggregates named in ``sums``.
    """
    named = [value.alias(name) for name, value in (sums or {}).items()]
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *named)
    useful = counts.filter(F.col("_rows") > 1 if only is None else only)
    parts = useful.select(key, F.ceil(F.col("_rows") / block).cast("int").alias("_parts"))
    return (
        skew_join(rows, parts, key)
        .withColumn("_part", F.pmod(F.xxhash64(item), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .withColumn("_i", F.least("_part", "_other"))
        .withColumn("_j", F.greatest("_part", "_other"))
        .drop("_parts", "_other")
    )


def meet(dealt: DataFrame, key: str) -> DataFrame:
    """All rows of one (key, _i, _j) together and sorted."""
    return dealt.repartition(key, "_i", "_j").sortWithinPartitions(key, "_i", "_j")


def whole_keys(frames: Iterator[pd.DataFrame], keys: list[str], at_least: int = 20_000) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of sorted rows joined up such that no key is divided; with each, the position where every key starts."""
    held: list[pd.DataFrame] = []
    rows = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        rows += len(frame)
        if rows < at_least:
            continue
        joined = pd.concat(held, ignore_index=True)
        starts = _starts(joined, keys)
        last = int(starts[-1])
        if last:
            yield joined.iloc[:last], starts[:-1]
        held = [joined.iloc[last:].reset_index(drop=True)]
        rows = len(held[0])
    if rows:
        joined = pd.concat(held, ignore_index=True)
        yield joined, _starts(joined, keys)


def _starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(frame), bool)
    new[0] = True
    for key in keys:
        values = frame[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (each node's smallest known node, at first itself) after adding the links a-b."""
    while len(a):
        a, b = label[a], label[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            break
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
    return label
