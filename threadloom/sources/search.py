"""Search responses: JSON text inside a ``body`` field, with the query and offset that asked for it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.coerce import iso_timestamp
from threadloom.schemas import SEARCH_BODY


def _parsed(raw: DataFrame) -> DataFrame:
    return raw.withColumn("_b", F.from_json(F.get_json_object("response", "$.body"), SEARCH_BODY))


def _bodies(raw: DataFrame) -> DataFrame:
    """``response`` text to the parsed body; what has none is in :func:`serp_rejects`."""
    return _parsed(raw).filter(F.col("_b.input.request_id").isNotNull())


def serp_rejects(raw: DataFrame) -> DataFrame:
    """Responses that cannot be stored, with ``reject_reason``: no readable body, or one without a request id."""
    reason = F.when(F.try_parse_json(F.get_json_object("response", "$.body")).isNull(), "bad_body").otherwise("no_request_id")
    return _parsed(raw).filter(F.col("_b.input.request_id").isNull()).withColumn("reject_reason", reason).drop("_b")


def serp_searches(raw: DataFrame) -> DataFrame:
    """One metadata row per response (``search_query``, ``pagination_start``, ``response`` in)."""
    general = F.col("_b.general")
    return _bodies(raw).select(
        F.col("_b.input.request_id").alias("request_id"),
        "search_query",
        general["search_engine"].alias("search_engine"),
        general["results_cnt"].alias("results_count"),
        general["search_time"].alias("search_time"),
        general["language"].alias("language"),
        F.initcap(general["mobile"].cast("string")).alias("is_mobile"),
        iso_timestamp(general["timestamp"]).alias("timestamp"),
        "pagination_start",
    )


def serp_results(raw: DataFrame) -> DataFrame:
    """One row per organic result; a missing description becomes '', an explicit null stays null."""
    rows = _bodies(raw).select(
        "search_query",
        F.col("_b.input.request_id").alias("serp_request_id"),
        iso_timestamp(F.col("_b.general.timestamp")).alias("created_at"),
        F.posexplode("_b.organic").alias("_pos", "_r"),
    )
    description = F.when(F.col("_r.description").isNull(), F.lit("")).otherwise(
        F.try_variant_get(F.col("_r.description"), "$", "string")
    )
    return rows.select(
        F.md5(F.concat_ws(":", "serp_request_id", "_pos")).alias("id"),
        F.col("search_query").alias("query"),
        "serp_request_id",
        F.col("_r.link").alias("link"),
        F.col("_r.title").alias("title"),
        description.alias("description"),
        F.col("_r.rank").alias("rank"),
        F.col("_r.global_rank").alias("global_rank"),
        "created_at",
    )
