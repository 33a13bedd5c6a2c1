"""Expressions over ``array<double>``, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row; inside a lambda a plain expression is computed anew for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def unit(a: Column) -> Column:
    return bound(norm(a), lambda length: F.transform(a, lambda x: x / length))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / (norm(a) * norm(b))


def usable(a: Column) -> Column:
    """Set, non-empty and of non-zero length; cosine distance is undefined otherwise."""
    return F.coalesce(a.isNotNull() & (F.size(a) > 0) & (norm(a) > 0), F.lit(False))
