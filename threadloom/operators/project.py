"""Map of vectors in two or more dimensions: a weighted neighbour graph laid out by forces, started from principal axes."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.vectors import bound, unit, usable
from threadloom.operators.neighbours import knn_graph
from threadloom.operators.skew import skew_join
from threadloom.session import cut, discard

# Neighbours and minimum distance used for the map.
NEIGHBOURS = 10
MIN_DIST = 0.0

# All points move at once, so steps are kept short or neighbours overshoot each other.
_STEP = 0.1
_STEPS = 64
_NEGATIVES = 5
_BUCKET_ROWS = 10_000


# --- graph weights ---


def _scale(distances: Column, nearest: Column, target: Column) -> Column:
    """Sigma by bisection, so that the summed weights exp(-max(0, d - rho) / sigma) meet the target."""

    def step(state: Column, _: Column) -> Column:
        mid = state["mid"]
        total = F.aggregate(
            distances, F.lit(0.0), lambda s, d: s + F.exp(-F.greatest(F.lit(0.0), d - nearest) / mid)
        )
        too_wide = total > target
        low, high = F.when(too_wide, state["low"]).otherwise(mid), F.when(too_wide, mid).otherwise(state["high"])
        middle = F.when(high.isNull(), mid * 2).otherwise((low + high) / 2)
        return F.struct(low.alias("low"), high.alias("high"), middle.alias("mid"))

    start = F.struct(F.lit(0.0).alias("low"), F.lit(None).cast("double").alias("high"), F.lit(1.0).alias("mid"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), start, step, lambda s: s["mid"])


def fuzzy_weights(knn: DataFrame) -> DataFrame:
    """(src, dst, weight) of the directed graph: 1 for the nearest, falling with distance at a local scale."""
    grouped = knn.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("rank", "dst", "distance"))).alias("near"))

    def scaled(of: Column) -> Column:
        floor = 1e-3 * F.aggregate(of["ds"], F.lit(0.0), lambda s, d: s + d) / F.size(of["ds"])
        # Where neither scale nor distances are left (copies only), every weight is 1.
        sigma = F.greatest(_scale(of["ds"], of["rho"], of["target"]), floor, F.lit(1e-12))
        return F.struct(of["rho"].alias("rho"), sigma.alias("sigma"))

    def shaped(ds: Column) -> Column:
        rho = F.coalesce(F.array_min(F.filter(ds, lambda d: d > 0)), F.lit(0.0))
        return F.struct(ds.alias("ds"), rho.alias("rho"), F.log2(F.size(ds).cast("double")).alias("target"))

    # The bisection asks for the distances and what follows from them at each of its steps, so they are bound before.
    local = bound(bound(F.transform("near", lambda x: x["distance"]), shaped), scaled)
    weight = lambda x, by: F.exp(-F.greatest(F.lit(0.0), x["distance"] - by["rho"]) / by["sigma"])
    weighed = bound(local, lambda by: F.transform("near", lambda x: F.struct(x["dst"].alias("dst"), weight(x, by).alias("weight"))))
    return grouped.select("src", F.inline(weighed))


def fuzzy_graph(knn: DataFrame) -> DataFrame:
    """The symmetric graph: w = a + b - ab of the two directions, each edge listed both ways."""
    none, weight = F.lit(0.0), F.col("weight")
    ways = [("src", "dst", weight, none), ("dst", "src", none, weight)]
    listed = F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), out.alias("out"), back.alias("back")) for a, b, out, back in ways])
    both = fuzzy_weights(knn).select(F.inline(listed))
    summed = both.groupBy("src", "dst").agg(F.sum("out").alias("a"), F.sum("back").alias("b"))
    return summed.select("src", "dst", (F.col("a") + F.col("b") - F.col("a") * F.col("b")).alias("weight"))


# --- layout ---


def axis_names(n: int) -> list[str]:
    """x, y and further numbered axes."""
    return ["x", "y", *[f"c{i}" for i in range(3, n + 1)]][:n]


def pca(vectors: DataFrame, n_components: int = 2) -> DataFrame:
    """(unified_id, x, y, ...): the main axes, centred; an axis points where its largest component is positive."""
    # The fit goes over the rows several times, so unit vectors are computed once.
    rows = cut(vectors.filter(usable(F.col("embeddings"))).select(
        "unified_id", array_to_vector(unit(F.col("embeddings"))).alias("features")
    ))
    names = axis_names(n_components)
    model = PCA(k=n_components, inputCol="features", outputCol="pc").fit(rows)
    axes = model.pc.toArray()
    sign = [1.0 if axes[np.argmax(np.abs(axes[:, i])), i] > 0 else -1.0 for i in range(n_components)]
    placed = model.transform(rows).select("unified_id", vector_to_array("pc").alias("pc"))
    flat = cut(placed.select("unified_id", *[(F.col("pc")[i] * sign[i]).alias(name) for i, name in enumerate(names)]))
    discard(rows)
    means = flat.agg(*[F.avg(name) for name in names]).first()
    return flat.select("unified_id", *[(F.col(name) - mean).alias(name) for name, mean in zip(names, means, strict=True)])


def curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """a and b such that 1 / (1 + a d^2b) follows 1 up to min_dist and then exp(-(d - min_dist) / spread).

    Two numbers from a fixed grid, by damped least squares.
    """
    d = np.linspace(1e-3, 3 * spread, 300)
    goal = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    p = np.array([1.0, 1.0])
    damping = 1e-3

    def model(q):
        return 1.0 / (1.0 + q[0] * d ** (2 * q[1]))

    for _ in range(200):
        value = model(p)
        power = d ** (2 * p[1])
        slope = -(value**2)[:, None] * np.column_stack([power, 2 * p[0] * power * np.log(d)])
        move = np.linalg.solve(slope.T @ slope + damping * np.eye(2), slope.T @ (goal - value))
        trial = np.maximum(p + move, 1e-3)
        if np.sum((goal - model(trial)) ** 2) < np.sum((goal - value) ** 2):
            p, damping = trial, damping / 2
        else:
            damping *= 4
    return float(p[0]), float(p[1])


def _clip(value: Column) -> Column:
    return F.greatest(F.lit(-4.0), F.least(F.lit(4.0), value))


def _gap2(one: list[Column], other: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [(p - q) ** 2 for p, q in zip(one, other, strict=True)])


def _pull(edges: DataFrame, points: DataFrame, axes: list[str], a: float, b: float) -> DataFrame:
    """Summed attraction per point. A point with very many edges is split by the joins and pre-summed."""
    here = points.select(F.col("unified_id").alias("src"), *[F.col(c).alias(f"s_{c}") for c in axes])
    there = points.select(F.col("unified_id").alias("dst"), *[F.col(c).alias(f"d_{c}") for c in axes])
    met = skew_join(skew_join(edges, there, "dst"), here, "src")
    gap2 = _gap2([F.col(f"s_{c}") for c in axes], [F.col(f"d_{c}") for c in axes])
    force = F.when(gap2 > 0, -2.0 * a * b * F.pow(gap2, b - 1.0) / (1.0 + a * F.pow(gap2, F.lit(b)))).otherwise(0.0)
    return met.withColumn("f", force * F.col("weight")).groupBy("src").agg(
        *[F.sum(_clip(F.col("f") * (F.col(f"s_{c}") - F.col(f"d_{c}")))).alias(f"f_{c}") for c in axes]
    )


def _push(points: DataFrame, axes: list[str], buckets: int, epoch: int, seed: int, a: float, b: float) -> DataFrame:
    """Adds the repulsion ``g_<axis>`` from the next few points in a random circle.

    The order is a hash of id, epoch and seed within buckets of bounded size, drawn anew each epoch: the partners
    are random yet the same on every rerun.
    """
    draw = F.xxhash64(F.col("unified_id"), F.lit(epoch), F.lit(seed))
    order = Window.partitionBy("_bucket").orderBy("_draw", "unified_id")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    drawn = points.withColumn("_draw", draw).withColumn("_bucket", F.pmod("_draw", F.lit(buckets)))
    drawn = drawn.withColumns({
        "_place": F.row_number().over(order), "_n": F.count(F.lit(1)).over(whole),
        "_ring": F.array(*[F.nth_value(F.struct(*axes), i).over(whole) for i in range(1, _NEGATIVES + 1)]),
    })
    pushed = {c: F.lit(0.0) for c in axes}
    for step in range(1, _NEGATIVES + 1):
        # Past the end of the circle come its first points; a circle of fewer points than steps goes round again.
        wrapped = F.try_element_at("_ring", ((F.col("_place") + (step - 1)) % F.col("_n") + 1).cast("int"))
        other = {c: F.coalesce(F.lead(c, step).over(order), wrapped[c]) for c in axes}
        gap2 = _gap2([F.col(c) for c in axes], list(other.values()))
        force = 2.0 * b / ((0.001 + gap2) * (1.0 + a * F.pow(gap2, F.lit(b))))
        pushed = {c: pushed[c] + F.coalesce(_clip(force * (F.col(c) - other[c])), F.lit(0.0)) for c in axes}
    return drawn.withColumns({f"g_{c}": pushed[c] for c in axes}).drop("_draw", "_bucket", "_place", "_n", "_ring")


def layout(
    start: DataFrame, edges: DataFrame, epochs: int = 30, min_dist: float = MIN_DIST, seed: int = 42,
) -> DataFrame:
    """Move all points together, ``epochs`` times, by the pull of their edges and the push of random others.

    Weights and forces are those of McInnes et al., "UMAP"; the axes are the columns of ``start`` beside the id.
    """
    a, b = curve(min_dist)
    axes = [c for c in start.columns if c != "unified_id"]
    n, reach = start.agg(F.count(F.lit(1)), F.max(F.greatest(*[F.abs(c) for c in axes], F.lit(0.0)))).first()
    buckets = max(1, -(-n // _BUCKET_ROWS))
    scale = 10.0 / reach if reach else 1.0
    points = start.select("unified_id", *[(F.col(c) * scale).alias(c) for c in axes])
    points, edges = cut(points), cut(edges)
    for epoch in range(epochs):
        rate = _STEP * (1.0 - epoch / epochs)
        pulled = _pull(edges, points, axes, a, b).withColumnRenamed("src", "unified_id")
        pushed = _push(points, axes, buckets, epoch, seed, a, b).join(pulled, "unified_id", "left")
        # An epoch reads the one before three times, so each is written before the next starts.
        moved = cut(pushed.select(
            "unified_id",
            *[(F.col(c) + rate * (F.coalesce(f"f_{c}", F.lit(0.0)) + F.col(f"g_{c}"))).alias(c) for c in axes],
        ))
        discard(points)
        points = moved
    discard(edges)
    return points


def project(
    vectors: DataFrame, method: str = "graph", n_neighbors: int = NEIGHBOURS, min_dist: float = MIN_DIST,
    epochs: int = 30, seed: int = 42, metric: str = "cosine", n_components: int = 2, neighbours: dict | None = None,
) -> DataFrame:
    """(unified_id, x, y, ...) by ``graph`` layout or by ``pca`` alone, on ``n_components`` axes.

    ``metric`` says how near two vectors are; ``neighbours`` are further options of :func:`knn_graph`.
    """
    if method not in ("graph", "pca"):
        raise ValueError("method must be 'graph' or 'pca'")
    start = pca(vectors, n_components)
    if method == "pca":
        return start
    edges = fuzzy_graph(knn_graph(vectors, n_neighbors, seed=seed, metric=metric, **(neighbours or {})))
    return layout(start, edges, epochs, min_dist, seed)
