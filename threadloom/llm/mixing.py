"""Mixing sources to target weights by repeating and thinning documents. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.rows import restore, wrap
from threadloom.operators.skew import skew_join
from threadloom.session import cut

WORD = r"[^\x20\x09-\x0D]+"
SHARE = 1.5
MOST_REPEATS = 2.0
CYCLE = (3, 1, 2)


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """``sizes(source, size)`` with ``weight``: the cycle's values along the sources by code point, null last.

    Sources are sorted over many tasks; a source's place is its place in its partition after those of all partitions
    before. The one window over everything has a row per partition.
    """
    sorted_ = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    dealt = cut(sorted_)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    place = F.col("_before") + F.row_number().over(within) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (place % len(cycle) + 1).cast("int"))
    return dealt.join(before, "_part").withColumn("weight", weight).drop("_part", "_before")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST_REPEATS) -> DataFrame:
    """``sizes(source, size, weight)`` with ``target`` and ``rate``.

    The sources share ``share`` times all sizes by weight; none gets more than ``most`` times its own size, and what is
    above goes to the others by weight, again and again until none is above. Each round is two sums over the sources: what
    the full ones hold, and the weight of the others. Sources without words or with a weight that is null or not positive
    get target 0.
    """
    usable = (F.col("size") > 0) & (F.coalesce("weight", F.lit(0.0)) > 0)
    rows = cut(
        sizes.withColumn("_cap", F.when(usable, F.col("size") * F.lit(most)).otherwise(F.lit(0.0)))
        .withColumn("_weight", F.when(usable, F.col("weight").cast("double")).otherwise(F.lit(0.0)))
    )
    total = (rows.agg(F.sum("size")).first()[0] or 0) * share
    level, before = 0.0, -1.0
    while level != before:
        before = level
        full = F.col("_cap") <= F.col("_weight") * F.lit(level)
        held, weight = rows.agg(F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight")))).first()
        level = (total - (held or 0.0)) / weight if weight else float("inf")
    target = F.when(F.col("_weight") > 0, F.least(F.col("_cap"), F.col("_weight") * F.lit(level))).otherwise(F.lit(0.0))
    return rows.select(
        "source", "size", "weight", target.alias("target"), F.coalesce(target / F.when(F.col("size") > 0, F.col("size")), F.lit(0.0)).alias("rate")
    )


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the seed and the id, or for a null id the text: 52 bits of an md5."""
    nameless = F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit(""))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), nameless))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(drawn: Column, rate: Column) -> Column:
    """floor(rate) copies and one more with probability equal to the fraction, decided by :func:`draw`."""
    whole = F.floor(rate)
    return (whole + F.when(drawn < rate - whole, 1).otherwise(0)).cast("long")


def _rated(rows: DataFrame, rates: DataFrame, source: str) -> DataFrame:
    """Each row with its source's target, size and rate; a source that most rows share is split by the join."""
    key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))
    right = rates.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("_source_key"),
        F.col("size").alias("_source_size"), F.col("target").alias("_target"), F.col("rate").alias("_rate"),
    )
    return skew_join(rows.withColumn("_source_key", key), right, "_source_key").drop("_source_key")


def mixture(docs: DataFrame, weights=cyclic_weights, share: float = SHARE, most: float = MOST_REPEATS, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs(doc_id, text, source)``.

    ``weights`` adds a column ``weight`` to (source, size), one row per source. A null source is a source of its own; a
    null or empty text has size 0 and takes 0 words. Rows under one id share the draw, as
    do those of one text without an id. No rows give no rows.
    """
    sizes = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), seed).alias("_draw")))
    rates = targets(weights(sizes.groupBy("source").agg(F.sum("size").alias("size"))), share, most)
    times = copies(F.col("_draw"), F.col("_rate"))
    return _rated(sizes, cut(rates), "source").select(
        "doc_id", "source", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        times.alias("copies"), (F.col("size") * times).alias("taken"),
    )


def mix(docs: DataFrame, weights=cyclic_weights, share: float = SHARE, most: float = MOST_REPEATS, seed: int = 0) -> DataFrame:
    """``docs`` with each row repeated as often as :func:`mixture` takes it, all columns as given."""
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("size"))
    rates = cut(targets(weights(sizes), share, most))
    drawn = draw(F.col("_doc_id"), F.col("_text"), seed).alias("_draw")
    rows = _rated(wrap(docs, ["doc_id", "text", "source"]).select("_row", "_source", drawn), rates, "_source")
    times = copies(F.col("_draw"), F.col("_rate")).cast("int")
    return restore(rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))))
