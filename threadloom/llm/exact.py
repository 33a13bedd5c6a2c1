"""Exact duplicates: a Bloom filter of repeated hashes decides which rows shuffle at all. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.rows import keep_rows, restore, text_hash, wrap
from threadloom.operators.skew import skew_join
from threadloom.session import cut

WHITE = r"[\x20\x09-\x0D]+"
# Bits per row, and the largest filter that is broadcast: 2^27 bits are at most 2^21 words of 64 bits, some 40 MB as a table.
BITS_PER_ROW = 16
MOST_BITS = 1 << 27
PROBES = 3


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text without ASCII white space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, ""), 256)


def _word(digest: Column, bits: int) -> Column:
    """The 64-bit word of the filter that a digest belongs to."""
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % (bits // 64)


def _places(digest: Column) -> list[Column]:
    """The bits within that word: PROBES numbers below 64."""
    return [F.conv(F.substring(digest, 13 + 2 * i, 2), 16, 10).cast("int") % 64 for i in range(PROBES)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _mask(digest: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), map(_bit, _places(digest)))


def repeated_words(digests: DataFrame, bits: int) -> DataFrame:
    """First pass over ``digests(sha)``: (word, mask) of the filter bits that were set by two rows or more.

    A bit counts up to any number in a partial aggregate, so a digest that a third of all rows share is no hot key.
    """
    slots = digests.select(_word(F.col("sha"), bits).alias("_w"), F.explode(F.array_distinct(F.array(*_places(F.col("sha"))))).alias("_b"))
    twice = slots.groupBy("_w", "_b").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return twice.groupBy("_w").agg(F.bit_or(_bit(F.col("_b"))).alias("_mask"))


def flag_repeated(rows: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """Second pass: ``rows(sha, ...)`` with ``_maybe``, false only where no other row has the digest. Nothing is shuffled."""
    found = rows.withColumn("_w", _word(F.col("sha"), bits)).join(F.broadcast(words), "_w", "left")
    mask = _mask(F.col("sha"))
    return found.withColumn("_maybe", F.coalesce(F.col("_mask").bitwiseAND(mask) == mask, F.lit(False))).drop("_w", "_mask")


def filter_bits(rows: int) -> int:
    """A power of two of at least BITS_PER_ROW a row, at most MOST_BITS.

    Beyond that the filter lets more rows through to the exact comparison; results stay the same.
    """
    return min(MOST_BITS, 1 << max(16, (BITS_PER_ROW * rows - 1).bit_length()))


def _decide(maybe: DataFrame) -> DataFrame:
    """``maybe(_doc_id, _th, sha, chars, _row)`` with the group's size, the row that stays and whether it is this one."""
    order = F.struct(-F.col("chars"), F.col("_doc_id").isNull(), F.col("_doc_id"), F.col("_th"), F.col("_row"))
    ordered = maybe.select("sha", "_doc_id", order.alias("_order"))
    groups = ordered.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), F.min("_order").alias("_best"), F.min_by("_doc_id", "_order").alias("keep_id"))
    return skew_join(maybe.select("*", order.alias("_order")), groups, "sha").withColumn("_kept", F.col("_order").eqNullSafe(F.col("_best")))


def _passes(keys: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The keys as a written table with a number a row, the filter over them, and its size."""
    keys = cut(keys.withColumn("_row", F.monotonically_increasing_id()))
    bits = filter_bits(keys.count())
    return keys, cut(repeated_words(keys, bits)), bits


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs(doc_id, text)``.

    Texts are equal when identical without ASCII white space (told by their SHA-256). Of equal texts the row with the
    most code points stays, then the smallest doc_id (null last), then the smallest hash of the text as it stands; of rows
    alike in all of that one is kept. Null texts count as empty ones. No rows give no rows.
    """
    keyed = docs.select(F.col("doc_id").alias("_doc_id"), F.col("text").alias("_text"))
    keys, words, bits = _passes(
        keyed.select("_doc_id", text_hash().alias("_th"), text_digest(F.col("_text")).alias("sha"), F.length(F.coalesce("_text", F.lit(""))).alias("chars"))
    )
    flagged = flag_repeated(keys, words, bits)
    alone = flagged.filter(~F.col("_maybe")).select(
        F.col("_doc_id").alias("doc_id"), F.col("_doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    grouped = _decide(flagged.filter("_maybe").drop("_maybe")).select(
        F.col("_doc_id").alias("doc_id"), "keep_id", "group_size", F.col("_kept").alias("kept"), F.col("sha").alias("text_sha256")
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of :func:`exact_groups`, all columns as given.

    Rows that the filter rules out as copies go straight through; only the others meet the decisions in a join.
    """
    keys, words, bits = _passes(
        docs.select(F.col("doc_id").alias("_doc_id"), F.col("text").alias("_text")).select(
            "_doc_id", text_hash().alias("_th"), text_digest(F.col("_text")).alias("sha"), F.length(F.coalesce("_text", F.lit(""))).alias("chars")
        )
    )
    decided = _decide(flag_repeated(keys, words, bits).filter("_maybe").drop("_maybe")).select("_doc_id", "_th", "_kept")
    flagged = flag_repeated(wrap(docs, ["text"]).withColumn("sha", text_digest(F.col("_text"))), words, bits)
    alone = restore(flagged.filter(~F.col("_maybe")))
    return alone.unionByName(keep_rows(restore(flagged.filter("_maybe")), decided))
