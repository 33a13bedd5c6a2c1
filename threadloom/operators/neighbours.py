"""Cosine nearest neighbours: exact over a grid of blocks or over cells, or approximate by neighbour descent; the caller chooses.

Exact: vectors are dealt into ``blocks`` by hash. A block is first searched by itself, which bounds how far a vector's neighbours
can be; then every pair of blocks meets in one task, so a vector is sent ``blocks`` times, and a pair is scored once, in single
precision, for both its directions. Distances, in double precision, are computed of those pairs only that the bounds and the error of
a score do not rule out. The work is that of all pairs, which an exact search over data without structure needs. Descent (Dong et
al., "Efficient K-Nearest Neighbor Graph Construction") starts from neighbours within blocks along random directions and then looks at the
neighbours of neighbours, which meet around each vector, at most twice as many as are kept, where only pairs with a newcomer are
compared; it ends when a sample shows enough
recall, and is for maps too large for all pairs.

Cells: vectors are put into the cells of k-means centres and first compared within them, which bounds how far a vector's
neighbours can be; then it is sent to those cells only in which, by the triangle inequality, one as near can lie. The result is
that of the exact search, or, with ``nprobe``, of the nearest cells alone. Data without structure is sent everywhere, each vector
once to every part of a cell, and every part once to each group of about ``cell_rows`` that ask it.

Copies of a vector are compared once. As equal distances go by id, only the k + 1 smallest ids of a group of
copies can be anybody's neighbours, so a vector that makes up a third of all rows adds no work.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.vectors import dot, norm, unit, usable
from threadloom.operators.skew import skew_join
from threadloom.session import cut, discard

# The functions below travel to the executors by value, so those need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCKS = 8
# Rows of a block in the exact search at most: more vectors make more blocks, so a task holds two blocks of this size at any size of data.
MOST_ROWS = 32_768
CELLS, CELL_ROWS = 16, 32_768
# Distances held at a time while two blocks are compared.
_DISTANCES = 1 << 22
# Right rows that set a first bound of a row's k-th distance.
_SOME = 4096
_FOUND = "rep string, other string, distance double"
# Distances are compared to nine places; the id settles what is equal so far.
_PLACES = 9
METHODS = ("exact", "cells", "descent")
# Bounds are compared with this much to spare, as distances are rounded.
_SLACK = 1e-6
METRICS = ("cosine", "euclidean")
# Descent ends when this share of the true neighbours of so many vectors is found; a round that finds no more than that in addition is slow.
RECALL, SOME_VECTORS, LEAST_GAIN = 0.93, 256, 0.01


def _distances(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """Cosine distances of unit vectors, or Euclidean ones."""
    if metric == "cosine":
        return np.clip(1.0 - left @ right.T, 0.0, 2.0)
    squares = (left * left).sum(1)[:, None] + (right * right).sum(1)[None] - 2.0 * left @ right.T
    return np.sqrt(np.maximum(squares, 0.0))


def _apart(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """The distance of each left row to the right row beside it."""
    if metric == "cosine":
        return np.clip(1.0 - np.einsum("ij,ij->i", left, right), 0.0, 2.0)
    return np.sqrt(((left - right) ** 2).sum(1))


def _scores(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """What rules pairs out before distances are computed, higher for nearer ones: cosines, or squared distances below zero."""
    if metric == "cosine":
        return left @ right.T
    return 2.0 * left @ right.T - (left * left).sum(1)[:, None] - (right * right).sum(1)[None]


def _lowest(left: np.ndarray, right: np.ndarray, k: int, limit: np.ndarray | None, metric: str) -> np.ndarray:
    """Per left row a score that none of its k nearest right rows is below.

    It follows from ``limit``, a distance within which they lie; where that is not known, the k-th nearest of some of the right
    rows sets it. Scores of unit vectors are of single precision; their error is added.
    """
    limit = np.full(len(left), np.inf) if limit is None else limit.astype(np.float64)
    unknown = np.flatnonzero(~np.isfinite(limit))
    some = right[:: max(1, len(right) // _SOME)]
    step = max(1, _DISTANCES // len(some))
    for at in range(0, len(unknown) if len(some) >= k else 0, step):
        rows = unknown[at : at + step]
        away = np.partition(-_scores(left[rows], some, metric), k - 1, axis=1)[:, k - 1].astype(np.float64)
        limit[rows] = 1.0 + away if metric == "cosine" else np.sqrt(np.maximum(away, 0.0))
    limit = np.where(np.isnan(limit), np.inf, limit) + 2 * 10.0**-_PLACES
    dims = left.shape[1] + 8
    if metric == "cosine":
        return (1.0 - limit - dims * 2.0**-22).astype(np.float32)
    return -(limit**2) - dims * 2.0**-48 * max((left * left).sum(1).max(), (right * right).sum(1).max())


def _first(row: np.ndarray, col: np.ndarray, found: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, distance): the first k of each row by distance and id."""
    by_id = np.empty(len(ids), np.int64)
    by_id[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    order = np.lexsort((by_id[col], found, row))
    row, col, found = row[order], col[order], found[order]
    first = np.arange(len(row)) - np.searchsorted(row, row, "left") < k
    return row[first], ids[col[first]], found[first]


def _nearest(
    left: np.ndarray, right: np.ndarray, ids: tuple[np.ndarray | None, np.ndarray], k: int, metric: str,
    limits: tuple[np.ndarray | None, np.ndarray | None] = (None, None),
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, id, distance) of the k nearest right rows of each left row, equal distances by id; ``ids`` are those of either side.

    Where the left ones are given too, the same for the right rows among the left ones follows, from the same scores.
    ``limits`` bound how far the neighbours of either side's rows can be; farther ones may be left out.
    """
    both = ids[0] is not None
    a, b = (side.astype(np.float32) if metric == "cosine" else side for side in (left, right))
    low = [_lowest(a, b, k, limits[0], metric)[:, None]]
    if both:
        low.append(_lowest(b, a, k, limits[1], metric)[None])
    hits: list[list] = [[] for _ in low]
    step = max(1, _DISTANCES // max(1, len(right)))
    for at in range(0, len(left), step):
        scores = _scores(a[at : at + step], b, metric)
        for side, least in enumerate(low):
            row, col = np.divmod(np.flatnonzero(scores >= (least[at : at + step] if side == 0 else least)), len(right))
            row += at
            hits[side].append((row, col, np.round(_apart(left[row], right[col], metric), _PLACES)))
    met = [[np.concatenate(x) for x in zip(*side, strict=True)] for side in hits]
    out = [_first(*met[0], ids[1], k)]
    if both:
        row, col, found = met[1]
        out.append(_first(col, row, found, ids[0], k))
    return out


def _matrix(side: pd.DataFrame) -> np.ndarray:
    return np.array(side["vec"].tolist(), dtype=np.float64)


def _limit(side: pd.DataFrame) -> np.ndarray | None:
    return side["limit"].fillna(np.inf).to_numpy(np.float64) if "limit" in side else None


def _compare(k: int, metric: str):
    """The k nearest of ``left`` in ``right``, and those of ``right`` in ``left`` if asked for."""

    def found(left: pd.DataFrame, right: pd.DataFrame, both: bool = False) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"rep": np.zeros(0, object), "other": np.zeros(0, object), "distance": np.zeros(0)})
        names = [left["rep"].to_numpy(), right["rep"].to_numpy()]
        sides = _nearest(_matrix(left), _matrix(right), (names[0] if both else None, names[1]), k, metric, (_limit(left), _limit(right)))
        frames = [pd.DataFrame({"rep": n[row], "other": other, "distance": far}) for n, (row, other, far) in zip(names, sides, strict=False)]
        return pd.concat(frames, ignore_index=True).astype({"rep": object, "other": object})

    return found


def _within(k: int, metric: str):
    found = _compare(k, metric)
    return lambda place: found(place, place)


def _limits(near: DataFrame, k: int) -> DataFrame:
    """(rep, limit): the distance within which the k nearest of a vector lie, null where fewer are known."""
    return near.groupBy("rep").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("limit"))


def _exact(distinct: DataFrame, k: int, blocks: int, metric: str = "cosine") -> DataFrame:
    """Each block by itself, which bounds how far neighbours can be; then every pair of blocks in one task, once for both directions.

    A task passes on k rows per vector at most.
    """
    placed = cut(distinct.select("rep", "vec", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int").alias("block")))
    near = cut(placed.groupBy("block").applyInPandas(_within(k, metric), _FOUND))
    known = cut(placed.join(_limits(near, k), "rep", "left"))
    discard(placed)
    sent = known.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).filter("_other <> block").select(
        "rep", "vec", "limit", (F.col("block") < F.col("_other")).alias("_left"),
        F.least("block", "_other").alias("_i"), F.greatest("block", "_other").alias("_j"),
    )
    compare = _compare(k, metric)

    def across(place: pd.DataFrame) -> pd.DataFrame:
        return compare(place[place["_left"]], place[~place["_left"]], both=True)

    return near.unionByName(sent.groupBy("_i", "_j").applyInPandas(across, _FOUND))


def placed_in_cells(distinct: DataFrame, cells: int, cell_rows: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """(rep, vec, cell, away, _parts, _part, _radius) and the centres: each vector in the cell of its nearest centre.

    A cell of more than ``cell_rows`` vectors is cut into parts by hash; ``_radius`` is how far its vectors lie from its
    centre. The centres, of which there are ``cells``, are all that the driver and the tasks hold.
    """
    features = distinct.select(array_to_vector("vec").alias("features"))
    centres = np.array(KMeans(k=cells, maxIter=8, seed=seed).fit(features).clusterCenters())

    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            far = _distances(np.array(frame["vec"].tolist()), centres, "euclidean")
            cell = far.argmin(1)
            yield frame.assign(cell=cell.astype(np.int32), away=far[np.arange(len(frame)), cell])

    placed = cut(distinct.select("rep", "vec").mapInPandas(nearest, "rep string, vec array<double>, cell int, away double"))
    stats = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("_parts"), F.max("away").alias("_radius"))
    own = placed.join(F.broadcast(stats), "cell").withColumn("_part", F.pmod(F.xxhash64("rep"), F.col("_parts")).cast("int"))
    return own, centres


def _router(own: DataFrame, centres: np.ndarray, metric: str, nprobe: int | None):
    """A function from rows to (row, cell, part): every part of a cell, but its own, that may hold one of a row's neighbours."""
    between = np.maximum(_distances(centres, centres, "euclidean"), 1e-12)
    cells = own.groupBy("cell").agg(F.max("_parts").alias("_parts"), F.max("_radius").alias("_radius")).collect()
    radius, parts = np.full(len(centres), -np.inf), np.zeros(len(centres), int)
    for row in cells:
        radius[row["cell"]], parts[row["cell"]] = row["_radius"], row["_parts"]

    def route(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell, limit = frame["cell"].to_numpy(), frame["limit"].fillna(np.inf).to_numpy(np.float64)
        if metric == "cosine":
            limit = np.sqrt(2.0 * limit)
        far = _distances(_matrix(frame), centres, "euclidean")
        sphere = far - radius[None]
        plane = (far**2 - frame["away"].to_numpy()[:, None] ** 2) / (2.0 * between[cell])
        may = (np.maximum(sphere, plane) <= limit[:, None] + _SLACK) & (parts > 0)[None]
        if nprobe is not None:
            may &= far.argsort(1, kind="stable").argsort(1) < nprobe
        may[np.arange(len(frame)), cell] = True
        row, target = np.nonzero(may)
        many = parts[target]
        row, target = np.repeat(row, many), np.repeat(target, many)
        part = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        other = (target != cell[row]) | (part != frame["_part"].to_numpy()[row])
        return row[other], target[other].astype(np.int32), part[other].astype(np.int32)

    return route


_ROUTING = ["rep", "vec", "cell", "away", "_part", "limit"]


def routed(own: DataFrame, limits: DataFrame, centres: np.ndarray, metric: str, nprobe: int | None = None) -> DataFrame:
    """(rep, vec, limit, cell, _part): each vector once for every part of a cell, but its own, that may hold one of its neighbours.

    ``limits(rep, limit)`` says within which distance they lie (null: anywhere). A vector of another cell is at least as far
    as that cell's sphere, and as the plane midway between the two centres. ``nprobe`` keeps that many nearest cells.
    """
    return _sent(own.join(limits, "rep", "left").select(*_ROUTING), _router(own, centres, metric, nprobe))


def _sent(known: DataFrame, route, groups: dict | None = None) -> DataFrame:
    """The rows where they are routed to; with ``groups``, how many a part has, they are dealt over these."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            row, cell, part = route(frame)
            out = frame[["rep", "vec", "limit"]].iloc[row].assign(cell=cell, _part=part)
            if groups is not None:
                many = np.array([groups[at] for at in zip(cell.tolist(), part.tolist(), strict=True)], np.int64)
                out["_group"] = (pd.util.hash_array(out["rep"].to_numpy()) % many.astype(np.uint64)).astype(np.int32)
            yield out

    columns = "rep string, vec array<double>, limit double, cell int, _part int" + (", _group int" if groups is not None else "")
    return known.mapInPandas(send, columns)


def _asked(known: DataFrame, route) -> DataFrame:
    """(cell, _part, n): how many vectors are routed to each part."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            _, cell, part = route(frame)
            yield pd.DataFrame({"cell": cell, "_part": part}).value_counts().rename("n").reset_index()

    return known.mapInPandas(count, "cell int, _part int, n long").groupBy("cell", "_part").agg(F.sum("n").alias("n"))


def _in_cells(distinct: DataFrame, k: int, cells: int, cell_rows: int, nprobe: int | None, seed: int, metric: str) -> DataFrame:
    """Within parts of cells first; then what has to be asked elsewhere, in groups of about ``cell_rows`` on either side.

    What is asked where is counted before vectors are sent, so each is shuffled once, straight into its group.
    """
    if distinct.isEmpty():
        return distinct.select("rep", F.col("rep").alias("other"), F.lit(0.0).alias("distance"))
    own, centres = placed_in_cells(distinct, cells, cell_rows, seed)
    own = cut(own)
    near = cut(own.groupBy("cell", "_part").applyInPandas(_within(k, metric), _FOUND))
    known = cut(own.join(_limits(near, k), "rep", "left").select(*_ROUTING))
    route = _router(own, centres, metric, nprobe)
    groups = cut(_asked(known, route).select("cell", "_part", F.ceil(F.col("n") / cell_rows).cast("int").alias("_groups")))
    # One row per part of a cell: as many as there are vectors by ``cell_rows``, and cells.
    dealt = {(r["cell"], r["_part"]): r["_groups"] for r in groups.collect()}
    there = known.select("rep", "vec", "cell", "_part").join(groups, ["cell", "_part"]).withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))
    compare = _compare(k, metric)

    def ask(place: pd.DataFrame) -> pd.DataFrame:
        return compare(place[place["_asks"]], place[~place["_asks"]])

    columns = ["rep", "vec", "limit", "cell", "_part", "_group"]
    asking = _sent(known, route, dealt).select(*columns, F.lit(True).alias("_asks"))
    answering = there.withColumn("limit", F.lit(None).cast("double")).select(*columns, F.lit(False).alias("_asks"))
    return near.unionByName(asking.unionByName(answering).groupBy("cell", "_part", "_group").applyInPandas(ask, _FOUND))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each vector; a task passes on no more than that per vector."""
    nearest = Window.partitionBy("rep").orderBy("distance", "other")
    return found.withColumn("_place", F.row_number().over(nearest)).filter(F.col("_place") <= k).drop("_place")


def _distance(a: Column, b: Column, metric: str) -> Column:
    if metric == "cosine":
        return F.least(F.lit(2.0), F.greatest(F.lit(0.0), 1.0 - dot(a, b)))
    return norm(F.zip_with(a, b, lambda x, y: x - y))


def _nearest_of_some(distinct: DataFrame, k: int, some: int, seed: int, metric: str) -> DataFrame:
    """(rep, other, distance): the true k nearest of ``some`` vectors drawn by a hash; each batch of rows passes on k of each."""
    drawn = distinct.select("rep", "vec").orderBy(F.xxhash64("rep", F.lit(seed)), "rep").limit(some).collect()
    names, asked = np.array([r["rep"] for r in drawn], object), np.array([r["vec"] for r in drawn], np.float64)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(names) and len(frame):
                row, other, distance = _nearest(asked, _matrix(frame), (None, frame["rep"].to_numpy()), k, metric)[0]
                yield pd.DataFrame({"rep": names[row], "other": other, "distance": distance})

    return _best(distinct.select("rep", "vec").mapInPandas(search, _FOUND), k)


def _whole(batches: Iterator[pa.RecordBatch], key: str, at_least: int = 20_000) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``key`` joined up such that no key is divided."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= at_least:
            joined = pa.Table.from_batches(held).combine_chunks()
            keys = joined[key].to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield joined.slice(0, last).combine_chunks()
            held = joined.slice(last).combine_chunks().to_batches()
            rows = len(keys) - last
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _flat(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and the row of each; a null list has none."""
    lists = table[name].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), sizes)


def _lists(sizes: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, kind))


_NEAR = "n long, others array<long>, away array<float>"


def _found_near(names: np.ndarray, away: np.ndarray, keep: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per place (g, i) with something kept in ``keep[g, i, j]``: the names and distances of what is."""
    group, i, j = np.nonzero(keep)
    sizes = keep.sum(2)
    some = sizes > 0
    yield pa.RecordBatch.from_arrays(
        [pa.array(names[some]), _lists(sizes[some], names[group, j], pa.int64()), _lists(sizes[some], away[group, i, j], pa.float32())],
        ["n", "others", "away"],
    )


def _meetings(key: str, metric: str, wide: int | None = None):
    """All rows of a ``key`` meet; each gets the others nearer than its ``limit``, or, with ``wide``, so many nearest ones.

    Rows are (key, n, vec) and, without ``wide``, ``limit`` and ``fresh``: two that are both not fresh have met before. Keys are
    compared many at a time, each with as much room as the largest.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, key):
            ids, name = table[key].to_numpy(), table["n"].to_numpy()
            vec = _flat(table, "vec")[0].reshape(len(ids), -1)
            fresh = np.ones(len(ids), bool) if wide else table["fresh"].to_numpy()
            limit = np.full(len(ids), np.inf, np.float32) if wide else table["limit"].to_numpy()
            order = np.lexsort((~fresh, name, ids))
            order = order[np.append(True, (np.diff(ids[order]) != 0) | (np.diff(name[order]) != 0))]
            starts = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
            sizes = np.diff(np.append(starts, len(order)))
            by_size = np.argsort(sizes, kind="stable")
            by_size = by_size[np.add.reduceat(fresh[order].astype(np.int64), starts)[by_size] > 0]
            at = 0
            while at < len(by_size):
                # Keys of like size together, so little room is empty.
                upto = at + 1
                while upto < len(by_size) and (upto + 1 - at) * int(sizes[by_size[upto]]) ** 2 <= _DISTANCES // 4:
                    upto += 1
                chosen = by_size[at:upto]
                at, room = upto, int(sizes[chosen].max())
                place = starts[chosen][:, None] + np.minimum(np.arange(room)[None], sizes[chosen][:, None] - 1)
                there = np.arange(room)[None] < sizes[chosen][:, None]
                rows = order[place]
                held = vec[rows]
                met = held @ held.transpose(0, 2, 1)
                if metric == "cosine":
                    away = np.clip(1 - met, 0, 2)
                else:
                    squares = np.einsum("gid,gid->gi", held, held)
                    away = np.sqrt(np.maximum(squares[:, :, None] + squares[:, None] - 2 * met, 0))
                away = away.astype(np.float32)
                may = there[:, :, None] & there[:, None] & (fresh[rows][:, :, None] | fresh[rows][:, None]) & ~np.eye(room, dtype=bool)
                if wide and wide < room:
                    away[~may] = np.inf
                    may &= away <= np.partition(away, wide - 1, axis=2)[:, :, wide - 1 : wide]
                else:
                    may &= away < limit[rows][:, :, None]
                yield from _found_near(name[rows], away, may)

    return search


def _merged(wide: int):
    """Of all rows of one ``n`` the ``wide`` nearest others; ``fresh`` are those that the row with a vector did not have."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "n"):
            n = table["n"].to_numpy()
            other, row = _flat(table, "others")
            away, old = _flat(table, "away")[0], table["vec"].is_valid().to_numpy()
            order = np.lexsort((~old[row], other, n[row]))
            first = np.append(True, (np.diff(n[row][order]) != 0) | (np.diff(other[order]) != 0))[: len(order)]
            order = order[first]
            order = order[np.lexsort((other[order], away[order], n[row[order]]))]
            mine = n[row[order]]
            order = order[np.arange(len(mine)) - np.searchsorted(mine, mine) < wide]
            kept = np.flatnonzero(old)
            sizes = np.searchsorted(n[row[order]], n[kept], "right") - np.searchsorted(n[row[order]], n[kept], "left")
            vec = table["vec"].combine_chunks()
            vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(n[kept]), vec.take(pa.array(kept)), _lists(sizes, other[order], pa.int64()),
                    _lists(sizes, away[order], pa.float32()), _lists(sizes, ~old[row[order]], pa.bool_()),
                ],
                ["n", "vec", "others", "away", "fresh"],
            )

    return merge


def _along(vec: Column, directions: np.ndarray) -> Column:
    """How far a vector reaches along each of the directions."""

    @F.pandas_udf("array<double>")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series(list(np.array(column.tolist(), np.float64).reshape(len(column), -1) @ directions), dtype=object)

    return of(vec)


def _block(along: Column, edges: list[list[float]]) -> Column:
    """The block of each turn, as one number."""

    @F.pandas_udf("array<long>")
    def of(column: pd.Series) -> pd.Series:
        far = np.array(column.tolist()).reshape(len(column), -1)
        return pd.Series(list(np.stack([np.searchsorted(e, far[:, t]) * len(edges) + t for t, e in enumerate(edges)], axis=1)), dtype=object)

    return of(along)


def _first_near(numbered: DataFrame, wide: int, block_rows: int, turns: int, seed: int, metric: str) -> DataFrame:
    """(n, others, away) within blocks of about ``block_rows`` vectors along random directions."""
    some = numbered.select(F.size("vec").alias("d")).first()
    blocks = max(1, -(-numbered.count() // block_rows))
    directions = np.random.default_rng(seed).uniform(-1, 1, (some["d"] if some else 1, turns))
    along = cut(numbered.select("n", "vec", _along(F.col("vec"), directions).alias("_along")))
    edges = [[] for _ in range(turns)]
    if blocks > 1:
        reach = along.select(*[F.col("_along")[t].alias(f"_{t}") for t in range(turns)])
        edges = reach.approxQuantile(reach.columns, [i / blocks for i in range(1, blocks)], 0.1 / blocks)
    placed = along.select("n", "vec", F.explode(_block(F.col("_along"), edges)).alias("_i"))
    return placed.repartition("_i").sortWithinPartitions("_i").mapInArrow(_meetings("_i", metric, wide), _NEAR)


def _descent(distinct: DataFrame, k: int, pool: int, block_rows: int, rounds: int, recall: float, seed: int, metric: str) -> DataFrame:
    """Blocks along random directions, then the neighbours of neighbours, in both directions, until enough are found.

    ``pool * k`` neighbours are kept on the way, in a row per vector. Of the vectors that name one as their neighbour, at most as many
    are followed back, so a vector that everybody names stays bounded. Neighbours meet around a vector, and only pairs of which one
    has come there in the last round are compared. After ``rounds`` rounds those go on until of the true neighbours of SOME_VECTORS
    vectors the share ``recall`` is found; when the gains show that this will not be reached, half as many again are kept and all meet anew.
    Distances of unit vectors are of single precision on the way; those of the first k, and of what may be as near, are computed in the end.
    """
    n, wide = distinct.count(), pool * k
    numbered = cut(distinct.select(F.monotonically_increasing_id().alias("n"), "rep", "vec"))
    truth = _nearest_of_some(numbered.select(F.col("n").cast("string").alias("rep"), "vec"), k, SOME_VECTORS, seed, metric).collect()
    true = {(int(r["rep"]), int(r["other"])) for r in truth}
    asked = list({a for a, _ in true})
    kind = "array<float>" if metric == "cosine" else "array<double>"
    light = numbered.select("n", F.col("vec").cast(kind).alias("vec"))
    columns = f"n long, vec {kind}, others array<long>, away array<float>, fresh array<boolean>"

    def merged(*found: DataFrame) -> DataFrame:
        rows = found[0].select("n", "vec", "others", "away")
        for other in found[1:]:
            rows = rows.unionByName(other.withColumn("vec", F.lit(None).cast(kind)))
        return cut(rows.repartition("n").sortWithinPartitions("n").mapInArrow(_merged(wide), columns))

    empty = light.withColumns({"others": F.array().cast("array<long>"), "away": F.array().cast("array<float>")})
    state = merged(empty, _first_near(light, wide, block_rows, 2, seed, metric))
    shares, turn, anew = [], 0, False
    while True:
        mine = state.filter(F.col("n").isin(asked)).select("n", F.slice("others", 1, k - 1).alias("others")).collect() if asked else []
        hits = sum((r["n"], b) in true for r in mine for b in [r["n"], *r["others"]])
        shares.append(hits / max(1, len(true)))
        if turn >= rounds and (shares[-1] >= recall or wide >= 2 * n):
            break
        if turn > 1 and _ends_below(shares, recall):
            # Lists that are to grow take what lies somewhat farther; pairs that have met before meet again.
            wide, anew = wide + wide // 2, True
        turn += 1
        edges = state.select(F.col("n").alias("a"), F.explode(F.arrays_zip("others", "fresh")).alias("e"))
        edges = edges.select("a", F.col("e.others").alias("b"), (F.col("e.fresh") | F.lit(anew)).alias("fresh"))
        by_hash = Window.partitionBy("b").orderBy(F.col("fresh").desc(), F.xxhash64("a", F.lit(seed)))
        back = edges.withColumn("_place", F.row_number().over(by_hash)).filter(F.col("_place") <= wide)
        near = edges.select(F.col("a").alias("_with"), F.col("b").alias("n"), "fresh").unionByName(back.select(F.col("b").alias("_with"), F.col("a").alias("n"), "fresh"))
        last, many = F.try_element_at("away", F.lit(-1)), F.size("away")
        grown = F.when(2 * many >= wide, 2 * last - F.try_element_at("away", F.greatest(many / 2, F.lit(1)).cast("int"))).otherwise(float("inf"))
        limit = F.when(many >= wide, last).when(many > 0, grown).otherwise(float("inf")).cast("float")
        met = skew_join(near, state.select("n", "vec", limit.alias("limit")), "n")
        compared = met.repartition("_with").sortWithinPartitions("_with").mapInArrow(_meetings("_with", metric), _NEAR)
        after = merged(state, compared)
        discard(state)
        state, anew = after, False
    bound = F.try_element_at("away", F.least(F.size("away"), F.lit(k)))
    close = F.filter(F.arrays_zip("others", "away"), lambda x: x["away"] <= bound + 1e-5 * (1 + bound))
    pairs = state.filter(F.size("away") > 0).select("n", F.explode(close).alias("x")).select("n", F.col("x.others").alias("m"))
    ends = skew_join(pairs, numbered, "n").select("m", "rep", F.col("vec").alias("_a"))
    both = skew_join(ends, numbered.select(F.col("n").alias("m"), F.col("rep").alias("other"), F.col("vec").alias("_b")), "m")
    found = cut(both.select("rep", "other", F.round(_distance(F.col("_a"), F.col("_b"), metric), _PLACES).alias("distance")))
    discard(state)
    return found.unionByName(numbered.select("rep", F.col("rep").alias("other"), F.lit(0.0).alias("distance")))


def _ends_below(shares: list[float], recall: float) -> bool:
    """Whether gains that go on to shrink as in the last round, or have become small, end below ``recall``."""
    gain, before = shares[-1] - shares[-2], shares[-2] - shares[-3]
    if shares[-1] >= recall:
        return False
    return gain < LEAST_GAIN or (gain < before and shares[-1] + gain * gain / (before - gain) < recall)


def knn_graph(
    vectors: DataFrame, k: int = 10, method: str = "exact", blocks: int = BLOCKS, block_rows: int = 512, rounds: int = 3, pool: int = 3,
    seed: int = 42, metric: str = "cosine", cells: int = CELLS, cell_rows: int = CELL_ROWS, nprobe: int | None = None,
    recall: float = RECALL, block_most: int = MOST_ROWS,
) -> DataFrame:
    """(src, dst, distance, rank): the k nearest others of every usable vector, equal distances by id.

    ``method`` is "exact" (``blocks`` sets the grid, and blocks of more than about ``block_most`` vectors are made smaller), "cells" (``cells`` centres, groups of about ``cell_rows`` vectors and as
    many that ask; exact unless ``nprobe`` bounds the cells a vector is sent to) or "descent" (``block_rows``, ``pool``, the multiple of
    k that is kept on the way, and at least ``rounds`` rounds, until a sample shows ``recall``), whose neighbours are approximate;
    nothing switches between them.
    """
    if method not in METHODS or metric not in METRICS:
        raise ValueError(f"method must be one of {METHODS}, metric one of {METRICS}")
    vec = unit(F.col("embeddings")) if metric == "cosine" else F.col("embeddings")
    named = vectors.filter(usable(F.col("embeddings"))).select("unified_id", vec.alias("vec"))
    keyed = cut(named.withColumn("key", F.struct(F.xxhash64("vec").alias("a"), F.xxhash64(F.lit(1), "vec").alias("b"))))
    smallest = Window.partitionBy("key").orderBy("unified_id")
    copies = keyed.withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= k + 1)
    distinct = cut(copies.filter("place = 1").select(F.col("unified_id").alias("rep"), "vec", "key"))
    if method == "exact":
        found = _exact(distinct, k + 1, max(blocks, -(-distinct.count() // block_most)), metric)
    elif method == "cells":
        found = _in_cells(distinct, k + 1, cells, cell_rows, nprobe, seed, metric)
    else:
        found = _descent(distinct, k + 1, pool, block_rows, rounds, recall, seed, metric)
    return _expand(keyed, copies, distinct, found, k)


def _expand(keyed: DataFrame, copies: DataFrame, distinct: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """From distinct vectors back to all ids."""
    best = _best(found, k + 1)
    ids = copies.select("key", F.col("unified_id").alias("dst")).join(distinct.select("key", F.col("rep").alias("other")), "key")
    by_id = Window.partitionBy("rep").orderBy("distance", "dst")
    lists = (
        best.join(ids.select("other", "dst"), "other")
        .withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k + 1)
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("distance", "dst"))).alias("near"))
    )
    per_key = distinct.select("key", "rep").join(lists, "rep").select("key", "near")
    members = keyed.select(F.col("unified_id").alias("src"), "key")
    others = F.slice(F.filter("near", lambda x: x["dst"] != F.col("src")), 1, k)
    return (
        skew_join(members, per_key, "key")
        .select("src", F.posexplode(others).alias("pos", "x"))
        .select("src", F.col("x.dst").alias("dst"), F.col("x.distance").alias("distance"), (F.col("pos") + 1).alias("rank"))
    )
