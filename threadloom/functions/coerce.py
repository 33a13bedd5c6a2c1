"""Loose source values to declared types: a bad value becomes NULL and never costs the row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"


def to_long(value: Column) -> Column:
    """A JSON value (variant) as a whole number: numbers are truncated, text must spell an integer."""
    return F.try_variant_get(value, "$", "bigint")


def iso_timestamp(text: Column) -> Column:
    """ISO date or date-time, read as UTC when it names no zone.

    The pattern keeps out forms Spark would accept beyond ISO, such as a bare year or a time of day.
    """
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


def list_or_empty(values: Column, element: str = "string") -> Column:
    return F.coalesce(values, F.array().cast(f"array<{element}>"))


def struct_or_null(value: Column, fields: list[str]) -> Column:
    """The struct, or NULL when none of its fields is set."""
    any_set = reduce(lambda a, b: a | b, [value[f].isNotNull() for f in fields])
    return F.when(any_set, F.struct(*[value[f].alias(f) for f in fields]))
