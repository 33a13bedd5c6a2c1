"""Pushed messages: base64 of a JSON array of posts, with the ids in the attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.schemas import fields


def decode_envelopes(df: DataFrame, payload_schema: str) -> tuple[DataFrame, DataFrame]:
    """Decode ``data`` and ``attributes`` into one row per post.

    Returns (accepted, rejected). Accepted rows hold the post's fields, ``dataset_id``, ``snapshot_id`` and
    ``warning_reason`` (a missing job id is only a warning); rejected rows hold ``reject_reason``.
    """
    carried = [c for c in df.columns if c not in ("data", "attributes")]
    text = F.try_to_binary(F.col("data"), F.lit("base64")).cast("string")
    opened = df.select(
        *carried,
        F.try_element_at("attributes", F.lit("dataset_id")).alias("dataset_id"),
        F.try_element_at("attributes", F.lit("job_id")).alias("snapshot_id"),
        text.alias("_text"),
    )
    # from_json would take a lone object as a list of one, hence the test of the first character.
    parsed = opened.select(
        *carried, "dataset_id", "snapshot_id",
        F.when(F.col("_text").isNull(), "bad_base64")
        .when(F.try_parse_json("_text").isNull(), "bad_json")
        .when(~F.ltrim("_text").startswith("["), "not_a_list").alias("reject_reason"),
        F.from_json("_text", f"array<{fields(payload_schema).simpleString()}>").alias("_posts"),
    )
    accepted = (
        parsed.filter(F.col("reject_reason").isNull())
        .select(
            *carried, "dataset_id", "snapshot_id",
            F.when(F.coalesce("snapshot_id", F.lit("")) == "", "missing_job_id").alias("warning_reason"),
            F.explode("_posts").alias("_post"),
        )
        .select(*carried, "dataset_id", "snapshot_id", "warning_reason", "_post.*")
    )
    rejected = parsed.filter(F.col("reject_reason").isNotNull()).drop("_posts")
    return accepted, rejected
