"""Which platform a delivered batch belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.schemas import DATASET_PLATFORMS


def route(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Add ``platform`` from ``dataset_id``, and ``reject_reason`` where no platform is known.

    The mapping is configuration of a few entries, so it goes into the plan as a literal and no join is needed.
    """
    pairs = [F.lit(x) for pair in (mapping or DATASET_PLATFORMS).items() for x in pair]
    platform = F.try_element_at(F.create_map(*pairs), F.col("dataset_id"))
    return df.withColumn("platform", platform).withColumn(
        "reject_reason", F.when(F.col("platform").isNull(), "unknown_dataset_id")
    )
