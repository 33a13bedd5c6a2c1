"""Ids that depend on content only, so every rerun gives the same ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time pattern inside an id is the compact date-time followed by the dashed date.
ID_TIME_PATTERN = "yyyyMMddHHmmssyyyy-MM-dd"


def id_time(at: Column) -> Column:
    return F.date_format(F.coalesce(at, F.timestamp_seconds(F.lit(0))), ID_TIME_PATTERN)


def stable_id(prefix: str, parent: Column, author: Column, at: Column, text: Column) -> Column:
    """``prefix`` plus the md5 of parent, author, time to the second and text, joined without separators."""
    blank = F.lit("")
    key = F.concat(F.coalesce(parent, blank), F.coalesce(author, blank), id_time(at), F.coalesce(text, blank))
    return F.concat(F.lit(prefix), F.md5(key))
