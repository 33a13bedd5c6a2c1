"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's (?U) makes \s cover all Unicode white space, as the reference's trim does.
_EDGES = r"(?U)^\s+|\s+$"


def trim_ws(text: Column) -> Column:
    return F.regexp_replace(text, _EDGES, "")


def has_text(text: Column) -> Column:
    return text.isNotNull() & (F.length(trim_ws(text)) > 0)


def sentences(text: Column) -> Column:
    return F.split(text, r"[.!?\n]+")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def cut_query(url: Column) -> Column:
    """The address up to its first question mark; a fragment before it stays."""
    return F.substring_index(trim_ws(url), "?", 1)
