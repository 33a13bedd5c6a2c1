"""SimHash fingerprints, compared bit-sliced: 64 distances per machine word."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.blocks import deal, forest, meet, whole_keys
from threadloom.llm.components import components
from threadloom.llm.rows import keep_rows, text_hash
from threadloom.operators.skew import skew_join
from threadloom.session import cut, discard

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCK = 2048
# (query, lane) pairs whose counters are held at a time.
PAIRS_AT_ONCE = 1 << 15
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint_of(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The signed 64-bit SimHash of a whole text: a bit is set if over half of the shingles' XXH64 have it set.

    ``bytes.lower`` and ``bytes.split`` touch ASCII only: A-Z, and space with tab to carriage return.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 16):  # the bits of a very long text are added up in parts
        pairs = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """:func:`fingerprint_of` over a column. Null and wordless texts have fingerprint zero."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: fingerprint_of(text, shingle, seed)).astype("int64")

    return of(text)


def hex_fingerprint(value: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def within(query: np.ndarray, lane: np.ndarray, planes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Compare fingerprints with lanes of 64 others; returns the pairs' numbers that have a hit, and the hits as bits.

    ``planes[b, l]`` holds bit b of the 64 members of lane l. Bits that differ are added to counters that are stored
    vertically as well: one word per power of two, so a carry-save step updates 64 distances. Counters stop at
    ``radius + 1``; a pair of query and lane is abandoned as soon as all its distances exceed the radius.
    """
    digits = max(1, int(radius + 1).bit_length())
    start = (1 << digits) - 1 - radius  # counters overflow exactly when the distance exceeds the radius
    live = np.arange(len(query))
    counters = [np.full(len(query), ALL if start >> d & 1 else 0, np.uint64) for d in range(digits)]
    over = np.zeros(len(query), np.uint64)
    for bit in range(64):
        carry = planes[bit, lane[live]] ^ (np.uint64(0) - (query[live] >> np.uint64(bit) & np.uint64(1)))
        for d in range(digits):
            counters[d], carry = counters[d] ^ carry, counters[d] & carry
        over |= carry
        if bit % 4 == 3:
            stay = over != ALL
            if not stay.all():
                live, over, counters = live[stay], over[stay], [c[stay] for c in counters]
                if not len(live):
                    break
    return live, ~over


def _bit_planes(values: np.ndarray) -> np.ndarray:
    """Fingerprints (lanes, 64) as planes (64, lanes): member m of a lane becomes bit m of each plane's word."""
    bits = np.unpackbits(values.view(np.uint8).reshape(len(values), 64, 8), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").reshape(64, len(values))


def linked_pairs(values: np.ndarray, starts: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (a, b), a < b, of values of the same run whose fingerprints differ in at most ``radius`` bits."""
    lengths = np.diff(np.append(starts, len(values)))
    lanes = -(-lengths // 64)
    first_lane = np.cumsum(lanes) - lanes
    run_of = np.repeat(np.arange(len(starts)), lengths)
    place = np.arange(len(values)) - starts[run_of]
    padded = np.zeros((int(lanes.sum()), 64), "<u8")
    taken = np.zeros((int(lanes.sum()), 64), bool)
    base = np.zeros(int(lanes.sum()), np.int64)
    at_lane = first_lane[run_of] + place // 64
    padded[at_lane, place % 64] = values
    taken[at_lane, place % 64] = True
    base[at_lane] = starts[run_of] + place // 64 * 64
    planes = _bit_planes(padded)
    # A value is compared with its own lane and the later ones of its run, so each pair is seen once.
    own = place // 64
    todo = lanes[run_of] - own
    ends = np.cumsum(todo)
    at = 0
    while at < len(values):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        member = np.repeat(np.arange(at, upto), todo[at:upto])
        lane = at_lane[member] + np.arange(len(member)) - np.repeat(ends[at:upto] - todo[at:upto] - (ends[at - 1] if at else 0), todo[at:upto])
        found, hits = within(values[member], lane, planes, radius)
        on = np.unpackbits(hits.view(np.uint8).reshape(len(hits), 8), axis=1, bitorder="little").astype(bool) & taken[lane[found]]
        pair, bit = np.nonzero(on)
        a, b = member[found[pair]], base[lane[found[pair]]] + bit
        later = b > a
        yield a[later], b[later]
        at = upto


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK, pieces: int | None = None) -> DataFrame:
    """Links (a, b) between the distinct values of ``prints(fp)`` that connect all at most ``radius`` bits apart.

    The 64 bits are cut into ``pieces`` (radius + 1 by default). Two values so close differ in at most ``radius`` of them,
    so they agree in some choice of ``pieces - radius``: values are grouped by each choice. More pieces give more groups
    that are far smaller, for more values; the links are the same. Of every group (cut into blocks where it is large) only
    a spanning forest leaves the task: each value with the smallest one that it reaches there, never all pairs.
    """
    pieces = pieces or radius + 1
    cuts = [64 * p // pieces for p in range(pieces + 1)]
    bits = [((1 << cuts[p + 1]) - (1 << cuts[p])) for p in range(pieces)]
    masks = [sum(choice) for choice in combinations(bits, pieces - radius)]
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask))) for i, mask in enumerate(signed)]
    rows = prints.select("fp", F.explode(F.array(*keys)).alias("_key"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_keys(frames, ["_key", "_i", "_j"]):
            signed = frame["fp"].to_numpy()
            values = np.ascontiguousarray(signed).view(np.uint64)
            label = np.arange(len(values))
            for a, b in linked_pairs(values, starts, radius):
                label = forest(label, a, b)
            moved = np.flatnonzero(label != np.arange(len(values)))
            yield pd.DataFrame({"a": signed[moved], "b": signed[label[moved]]})

    dealt = deal(rows, "_key", "fp", block).select("_key", "_i", "_j", "fp")
    return meet(dealt, "_key").mapInPandas(compare, "a long, b long")


def near_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for each distinct value of ``prints(doc_id, fp)``.

    ``root`` names a group by its smallest fingerprint; ``component_id`` is the smallest doc_id in it, null if it has none.
    """
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(classes.select("fp"), radius))
    rooted = cut(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    discard(classes)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return skew_join(rooted, smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs(doc_id, text)``.

    Texts are linked when their fingerprints differ in at most ``radius`` bits. Null and empty texts share fingerprint
    zero and are linked like any other; a null doc_id takes part, but a component's id is null only if none has an id.
    Rows under one id are rows of their own. Extra columns are not read; no rows give no rows.
    """
    prints = cut(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")))
    classes = near_classes(prints, radius)
    return skew_join(prints, classes, "fp").select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all columns as given: that with the smallest doc_id (null last).

    Of several texts under that id the one with the smallest hash stays; rows alike in id and text count as one.
    """
    prints = cut(
        docs.select(F.col("doc_id"), F.col("text").alias("_text")).select(
            F.col("doc_id"), text_hash().alias("_th"), fingerprint(F.col("_text"), shingle).alias("fp")
        )
    )
    classes = near_classes(prints.select("doc_id", "fp"), radius).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("_th").alias("h"))
    members = cut(skew_join(prints, classes, "fp").select("root", F.col("doc_id").alias("_doc_id"), "_th", order.alias("_order")))
    best = members.groupBy("root").agg(F.min("_order").alias("_best"))
    # Struct comparison is null-safe, so a null id equals itself.
    decided = skew_join(members, best, "root").select("_doc_id", "_th", F.col("_order").eqNullSafe(F.col("_best")).alias("_kept"))
    kept = keep_rows(docs, decided)
    discard(prints, members)
    return kept
