"""Near-duplicate vectors by lattice hashing: projections decoded to E8 points, neighbouring cells probed, cosine verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.blocks import deal, forest, meet, whole_keys
from threadloom.llm.components import components
from threadloom.operators.skew import skew_join
from threadloom.session import cut, discard

COSINE = 0.95
# Unit vectors at cosine 0.95 are 0.32 apart, their projections on 8 normal directions about 0.87. With cells of scale 1,
# four tables and the eight nearest neighbouring cells, 98 % of such pairs meet; closer pairs meet more often.
TABLES = 4
PROBES = 8
SCALE = 1.0
SEED = 8
BLOCK = 1024


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, by rule: two coordinates of +-1, or eight of +-1/2 with an even number below 0."""
    out = np.zeros((240, 8))
    row = 0
    for (i, j), (a, b) in product(combinations(range(8), 2), product((1.0, -1.0), repeat=2)):
        out[row, [i, j]] = a, b
        row += 1
    for signs in product((0.5, -0.5), repeat=8):
        if sum(x < 0 for x in signs) % 2 == 0:
            out[row] = signs
            row += 1
    return out


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8: whole numbers with an even sum. Where the sum is odd, the worst rounding goes the other way."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_points(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 shifted by one half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def _hash(points: np.ndarray, table: int) -> np.ndarray:
    """Lattice points (..., 8) of one table as 64-bit keys; a collision only costs a comparison."""
    value = np.full(points.shape[:-1], 0x9E3779B97F4A7C15 * (table + 1) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(8):
        value ^= (2 * points[..., i]).astype(np.int64).view(np.uint64)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def cells(vectors: np.ndarray, tables: int, probes: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each unit vector's own cell (n, tables) and of the ``probes`` neighbouring cells nearest to it (n, tables, probes)."""
    neighbours = shortest_vectors()
    own = np.zeros((len(vectors), tables), np.int64)
    near = np.zeros((len(vectors), tables, probes), np.int64)
    for t in range(tables):
        axes = np.random.default_rng([seed, t, vectors.shape[1]]).standard_normal((vectors.shape[1], 8)) / scale
        projected = vectors @ axes
        point = nearest_points(projected)
        own[:, t] = _hash(point, t)
        toward = (projected - point) @ neighbours.T
        closest = np.argsort(-toward, axis=1, kind="stable")[:, :probes]
        near[:, t] = _hash(point[:, None, :] + neighbours[closest], t)
    return own, near


def _unit(column: pd.Series) -> np.ndarray:
    vectors = np.stack(column.to_numpy()).astype(float)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Set, not zero, and all components set and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _links(classes: DataFrame, cosine: float, tables: int, probes: int, scale: float, seed: int, block: int) -> DataFrame:
    """(a, b, n) of ``classes(cid, n, embedding)``: with n > 0, class a was found at ``cosine`` with n vectors of other
    classes (counts to be added up); with n = 0, links a-b that connect whatever is linked.
    """

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, same in frame.groupby(frame["embedding"].map(len)):
                own, near = cells(_unit(same["embedding"]), tables, probes, scale, seed)
                keys = np.concatenate([own[:, :, None], near], axis=2)
                n = keys.shape[2]
                yield pd.DataFrame({
                    "cid": np.repeat(same["cid"].to_numpy(), tables * n),
                    "_key": keys.ravel() ^ same["embedding"].map(len).to_numpy()[0],
                    "_table": np.tile(np.repeat(np.arange(tables, dtype=np.int32), n), len(same)),
                    "_own": np.tile(np.arange(n) == 0, len(same) * tables),
                })

    rows = classes.select("cid", "embedding").mapInPandas(place, "cid long, _key long, _table int, _own boolean")
    dealt = deal(rows, "_key", "cid", block, {"_owns": F.sum(F.col("_own").cast("int"))}, (F.col("_rows") > 1) & (F.col("_owns") > 0))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_keys(frames, ["_key", "_i", "_j"], 4 * block):
            for _, same in frame.groupby(frame["embedding"].map(len)):
                yield _compare(same, starts if len(same) == len(frame) else None, cosine, tables, probes, scale, seed)

    met = meet(dealt.join(classes.select("cid", "n", "embedding"), "cid"), "_key")
    return met.mapInPandas(compare, "a long, b long, n long")


def _compare(frame: pd.DataFrame, starts: np.ndarray | None, cosine: float, tables: int, probes: int, scale: float, seed: int) -> pd.DataFrame:
    cid, size, part = (frame[c].to_numpy() for c in ("cid", "n", "_part"))
    if starts is None:
        key = frame[["_key", "_i", "_j"]].to_numpy()
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
    unit = _unit(frame["embedding"])
    table, is_own, split = frame["_table"].to_numpy(), frame["_own"].to_numpy(bool), (frame["_i"] != frame["_j"]).to_numpy()
    found_a, found_b = [], []
    for first, end in zip(starts.tolist(), np.append(starts[1:], len(frame)).tolist(), strict=True):
        owns = first + np.flatnonzero(is_own[first:end])
        if end - first < 2 or not len(owns):
            continue
        a, b = np.nonzero(unit[owns] @ unit[first:end].T >= cosine)
        a, b = owns[a], first + b
        # Two owners of the cell are taken once, by class; parts of a large cell meet in one place only.
        fine = (cid[a] != cid[b]) & (~is_own[b] | (cid[a] < cid[b])) & (~split[a] | (part[a] != part[b]))
        found_a.append(a[fine])
        found_b.append(b[fine])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b))
    if len(a):
        distinct, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        own, near = cells(unit[distinct], tables, probes, scale, seed)
        counted = np.ones(len(a), bool)
        for low in range(0, len(a), 1 << 18):
            part_of = slice(low, low + (1 << 18))
            counted[part_of] = _first_meeting(
                at[: len(a)][part_of], at[len(a) :][part_of], own, near, table[a[part_of]], is_own[b[part_of]], cid[a[part_of]] < cid[b[part_of]]
            )
        a, b = a[counted], b[counted]
    links = np.zeros(len(frame), np.int64)
    np.add.at(links, a, size[b])
    np.add.at(links, b, size[a])
    label = forest(np.arange(len(frame)), a, b)
    moved = np.flatnonzero(label != np.arange(len(frame)))
    some = np.flatnonzero(links)
    return pd.DataFrame({
        "a": np.concatenate([cid[some], cid[moved]]),
        "b": np.concatenate([cid[some], cid[label[moved]]]),
        "n": np.concatenate([links[some], np.zeros(len(moved), np.int64)]),
    })


def _first_meeting(a, b, own, near, table, both_own, a_first) -> np.ndarray:
    """Whether a pair's meeting here is its first: two vectors may meet in several tables and cells but count once.

    ``a`` owns the cell, ``b`` owns it too or probes it. The order is by table, then the cell both own, then the cell of
    the class that comes later, then that of the earlier one. No list of pairs is kept anywhere.
    """
    met = np.zeros(len(a), bool)
    for t in range(own.shape[1]):
        here = own[a, t] == own[b, t]
        reach = (near[a, t] == own[b, t][:, None]).any(1) | (near[b, t] == own[a, t][:, None]).any(1)
        met |= (t < table) & (here | reach)
    back = (near[a, table] == own[b, table][:, None]).any(1)
    return ~met & (both_own | ~(a_first & back))


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE,
    seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors(vec_id, embedding)``.

    Each vector goes into one cell per table and looks into the ``probes`` nearest neighbouring cells; pairs that meet are
    verified by cosine in double precision, so none below ``cosine`` is linked. Equal vectors are one class that stands for
    all of them, and a crowded cell is compared in blocks; of each block only counts and a spanning forest leave the task.
    Vectors that are null, empty, zero or hold a null or non-finite component, and rows without a vec_id, link with nothing
    and are components of their own. Vectors of different length never meet. No rows give no rows.
    """
    fine = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", F.when(fine, F.col("embedding")).alias("embedding"))
    classes = (
        rows.filter("embedding IS NOT NULL").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    )
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()))
    links = cut(_links(classes, cosine, tables, probes, scale, seed, block))
    counts = links.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    roots = components(links.filter("n = 0").select("a", "b")).withColumnRenamed("node", "cid")
    known = classes.join(counts, "cid", "left").join(roots, "cid", "left")
    known = cut(known.select("embedding", "first", F.coalesce("root", "cid").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = skew_join(known, smallest, "root").select("embedding", "n_links", "component_id")
    component = F.coalesce("component_id", "vec_id")
    out = skew_join(rows, known, "embedding", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
    discard(classes)
    return out
