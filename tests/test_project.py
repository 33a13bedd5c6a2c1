import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from threadloom.functions.vectors import unit
from threadloom.operators.neighbours import knn_graph, placed_in_cells, routed
from threadloom.operators.project import curve, fuzzy_graph, fuzzy_weights, layout, pca, project


def frame(spark, matrix):
    return spark.createDataFrame(
        [(f"v{i:04d}", [float(x) for x in row]) for i, row in enumerate(matrix)], "unified_id string, embeddings array<double>"
    )


def brute(matrix, k):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    distance = np.round(np.clip(1 - unit @ unit.T, 0, 2), 9)
    out = set()
    for i in range(len(matrix)):
        others = sorted((distance[i, j], f"v{j:04d}") for j in range(len(matrix)) if j != i)[:k]
        out |= {(f"v{i:04d}", name, rank) for rank, (_, name) in enumerate(others, 1)}
    return out


def found(knn):
    return {tuple(r) for r in knn.select("src", "dst", "rank").collect()}


@pytest.fixture(scope="module")
def clusters():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8)) * 4
    return np.vstack([c + rng.normal(size=(40, 8)) * 0.3 for c in centers])


@pytest.mark.parametrize("options", [{}, {"blocks": 3}, {"method": "cells", "cells": 6, "cell_rows": 25}, {"method": "cells", "cells": 3}])
def test_neighbours_are_exact_however_they_are_split(spark, clusters, options):
    assert found(knn_graph(frame(spark, clusters), 5, **options)) == brute(clusters, 5)


def test_a_vector_in_a_third_of_all_rows(spark, clusters):
    copied = clusters.copy()
    copied[::3] = clusters[0]
    assert found(knn_graph(frame(spark, copied), 4, blocks=5)) == brute(copied, 4)
    assert found(knn_graph(frame(spark, copied), 4, method="cells", cells=5, cell_rows=20)) == brute(copied, 4)


def test_bounds_rule_cells_out(spark, clusters):
    """Vectors go to few parts of other cells; groups stay small; few probes find nearly all, and no more than they should."""
    unit = clusters / np.linalg.norm(clusters, axis=1, keepdims=True)
    distinct = frame(spark, unit).withColumnsRenamed({"unified_id": "rep", "embeddings": "vec"})
    own, centres = placed_in_cells(distinct, 6, 30, 42)
    sizes = [r["count"] for r in own.groupBy("cell", "_part").count().collect()]
    assert sum(sizes) == 240 and max(sizes) <= 45 and len(sizes) >= 8
    far = np.linalg.norm(unit[:, None] - unit[None], axis=2)
    limit = np.sort(far, axis=1)[:, 5] ** 2 / 2
    limits = spark.createDataFrame([(f"v{i:04d}", float(x)) for i, x in enumerate(limit)], "rep string, limit double")
    sent = routed(own, limits, centres, "cosine").count() / 240
    nowhere = routed(own, limits.withColumn("limit", F.lit(None).cast("double")), centres, "cosine").count() / 240
    assert sent < 0.5 * nowhere and nowhere == len(sizes) - 1
    one = found(knn_graph(frame(spark, clusters), 5, method="cells", cells=6, cell_rows=30, nprobe=2))
    assert len(one & brute(clusters, 5)) >= 0.95 * len(clusters) * 5


@pytest.mark.parametrize("method", ["exact", "cells", "descent"])
def test_euclidean_neighbours(spark, clusters, method):
    gaps = np.round(np.sqrt(((clusters[:, None] - clusters[None]) ** 2).sum(2)), 9)
    want = {(f"v{i:04d}", f"v{j:04d}") for i in range(len(clusters)) for j in np.argsort(gaps[i], kind="stable")[1:5]}
    got = {(a, b) for a, b, _ in found(knn_graph(frame(spark, clusters), 4, method=method, metric="euclidean", block_rows=60))}
    assert len(got & want) >= (1.0 if method == "exact" else 0.9) * len(want)


def test_three_axes(spark, clusters):
    points = project(frame(spark, clusters[::4]), epochs=2, n_components=3, metric="euclidean")
    assert points.columns == ["unified_id", "x", "y", "c3"] and points.filter("c3 is not null").count() == len(clusters[::4])


def test_descent_finds_most_neighbours(spark, clusters):
    got, want = found(knn_graph(frame(spark, clusters), 5, method="descent", block_rows=40)), brute(clusters, 5)
    pairs = lambda edges: {(a, b) for a, b, _ in edges}
    assert len(got) == len(want) and len(pairs(got) & pairs(want)) >= 0.9 * len(want)


def test_blocks_stay_small(spark, clusters, monkeypatch):
    """However many vectors, a task gets two blocks of bounded size."""
    from threadloom.operators import neighbours

    taken = []
    exact = neighbours._exact
    monkeypatch.setattr(neighbours, "_exact", lambda distinct, k, blocks, metric: taken.append(blocks) or exact(distinct, k, blocks, metric))
    assert found(knn_graph(frame(spark, clusters), 5, blocks=2, block_most=50)) == brute(clusters, 5) and taken == [5]


def test_descent_goes_on_until_enough_is_found(spark):
    """Vectors without clusters, of which one round from small blocks with a narrow pool finds few neighbours."""
    plain = np.random.default_rng(5).normal(size=(400, 16))
    edges = knn_graph(frame(spark, plain), 5, method="descent", block_rows=20, rounds=1, pool=1)
    pairs = lambda edges: {(a, b) for a, b, _ in edges}
    got, want = pairs(found(edges)), pairs(brute(plain, 5))
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_neighbours_that_have_met_are_not_compared_again(metric):
    """Around a vector only pairs with a newcomer are compared, many vectors at a time; what lies beyond a limit is left out."""
    import pyarrow as pa

    from threadloom.operators.neighbours import _meetings

    rng = np.random.default_rng(2)
    vec = rng.normal(size=(40, 8)) if metric == "euclidean" else (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.normal(size=(40, 8)))
    away = 1 - vec @ vec.T if metric == "cosine" else np.sqrt(((vec[:, None] - vec[None]) ** 2).sum(2))
    limit = np.median(away)
    members = {c: sorted(rng.choice(40, size, replace=False).tolist()) for c, size in ((3, 12), (5, 1), (9, 7), (11, 20))}
    newcomers = {3: set(members[3][:2]), 5: set(members[5]), 9: set(), 11: set(members[11][5:9])}
    rows = [(c, m, m in newcomers[c]) for c, of in members.items() for m in of] + [(3, members[3][0], False)]
    rows.sort(key=lambda r: r[0])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]),
         pa.array(np.full(len(rows), limit, np.float32)), pa.array([vec[r[1]].tolist() for r in rows])],
        ["_with", "n", "fresh", "limit", "vec"],
    )
    got = [(r["n"], o, round(d, 4)) for out in _meetings("_with", metric)(iter(batch.slice(i, 9) for i in range(0, len(rows), 9))) for r in out.to_pylist() for o, d in zip(r["others"], r["away"], strict=True)]
    want = [(a, b, round(away[a, b], 4)) for c, of in members.items() for a in of for b in of if a != b and {a, b} & newcomers[c] and away[a, b] < limit]
    assert len(got) == len(want) > 20
    assert all(g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-3 for g, w in zip(sorted(got), sorted(want), strict=True))


def test_descent_of_few_vectors(spark):
    """None, one, two, and copies alone."""
    some = [[1.0, 0.0], [0.0, 1.0], [1.0, 0.0], None, [0.0, 0.0]]
    for n, edges in ((0, 0), (1, 0), (2, 2), (3, 6), (5, 6)):
        given = spark.createDataFrame([(f"v{i}", v) for i, v in enumerate(some[:n])], "unified_id string, embeddings array<double>")
        got = found(knn_graph(given, 3, method="descent"))
        assert len(got) == edges and found(knn_graph(given, 3)) == got


def test_a_vector_is_sent_once_per_block(spark, clusters):
    from threadloom.operators.neighbours import _exact

    distinct = frame(spark, clusters).select(F.col("unified_id").alias("rep"), F.col("embeddings").alias("vec"))
    plan = _exact(distinct, 5, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "Join" not in plan


def test_what_is_asked_of_a_cell_is_sent_once(spark, clusters):
    """Vectors go straight to the group they are compared in: one shuffle, and none to find the group."""
    from threadloom.operators.neighbours import _in_cells

    distinct = frame(spark, clusters).withColumnsRenamed({"unified_id": "rep", "embeddings": "vec"})
    plan = _in_cells(distinct, 5, 3, 30, None, 42, "euclidean")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "_kh" not in plan


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_two_blocks_are_scored_once_for_both(clusters, monkeypatch, metric):
    """What is known to lie too far is ruled out by one score a pair; both sides get the neighbours of a plain search."""
    from threadloom.operators import neighbours

    sides = [clusters[::2], clusters[1::2]]
    if metric == "cosine":
        sides = [side / np.linalg.norm(side, axis=1, keepdims=True) for side in sides]
    names = [np.array([f"{mark}{i:03d}" for i in range(120)], object) for mark in "ab"]
    far = neighbours._distances(*sides, metric)
    limits = [np.sort(d, axis=1)[:, 6] for d in (far, far.T)]
    scored, scores = [], neighbours._scores
    monkeypatch.setattr(neighbours, "_scores", lambda a, b, m: scored.append(len(a) * len(b)) or scores(a, b, m))
    got = neighbours._nearest(*sides, names, 4, metric, limits)
    assert sum(scored) == 120 * 120
    for (row, other, distance), d, ids in zip(got, (far, far.T), names[::-1], strict=True):
        want = np.argsort(d, axis=1, kind="stable")[:, :4]
        assert (other.reshape(120, 4) == ids[want]).all() and (row.reshape(120, 4) == np.arange(120)[:, None]).all()
        assert np.allclose(distance.reshape(120, 4), np.take_along_axis(d, want, 1), atol=1e-8)


def test_fewer_vectors_than_neighbours(spark):
    knn = knn_graph(frame(spark, np.eye(3)), 10)
    assert rows(knn, "src", "dst", "distance")[:2] == [("v0000", "v0001", 1.0), ("v0000", "v0002", 1.0)] and knn.count() == 6


def test_unusable_vectors_are_left_out(spark):
    assert found(knn_graph(frame(spark, [[1, 0], [0, 0], [1, 1]]), 2)) == {("v0000", "v0002", 1), ("v0002", "v0000", 1)}


def test_weights_meet_their_target(spark, clusters):
    weights = fuzzy_weights(knn_graph(frame(spark, clusters), 8))
    summed = weights.groupBy("src").agg(F.sum("weight").alias("s"), F.max("weight").alias("m")).collect()
    assert all(abs(r["s"] - 3.0) < 1e-4 and r["m"] == 1.0 for r in summed)


def test_what_weights_need_is_computed_once(spark, clusters):
    """Neither a length nor a vector's distances are computed anew for each element, nor the weights for each direction."""
    assert "/ sqrt" not in str(unit(F.col("embeddings"))).lower()
    knn = spark.createDataFrame([("a", "b", 0.5, 1), ("b", "a", 0.5, 1)], "src string, dst string, distance double, rank int")
    plan = fuzzy_graph(knn)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and plan.lower().count("collect_list") == 1
    bisection = plan[plan.index("Generate") :]
    assert bisection.count("filter(") <= 1 and bisection.count("log2(") + bisection.count("LOG2(") <= 1


def test_graph_is_symmetric(spark, clusters):
    edges = {(r["src"], r["dst"]): r["weight"] for r in fuzzy_graph(knn_graph(frame(spark, clusters), 5)).collect()}
    assert all(abs(edges[(b, a)] - w) < 1e-12 and 0 < w <= 1 + 1e-12 for (a, b), w in edges.items())


@pytest.mark.parametrize("min_dist,a,b", [(0.1, 1.58, 0.90), (0.0, 1.93, 0.79), (0.5, 0.58, 1.33)])
def test_curve_constants(min_dist, a, b):
    got = curve(min_dist)
    assert got == pytest.approx((a, b), rel=0.03)


def kept_neighbours(points, knn):
    near = {}
    for src, dst, _ in knn:
        near.setdefault(src, set()).add(dst)
    names = sorted(points)
    place = np.array([points[n] for n in names])
    gaps = ((place[:, None] - place[None]) ** 2).sum(-1)
    np.fill_diagonal(gaps, np.inf)
    hits = total = 0
    for i, name in enumerate(names):
        order = {names[j] for j in np.argsort(gaps[i])[: len(near[name])]}
        hits, total = hits + len(order & near[name]), total + len(near[name])
    return hits / total


def test_layout_keeps_more_neighbours_than_the_axes(spark, clusters):
    df = frame(spark, clusters)
    knn = knn_graph(df, 8)
    start = pca(df)
    points = layout(start, fuzzy_graph(knn), epochs=15)
    placed = {r["unified_id"]: (r["x"], r["y"]) for r in points.collect()}
    flat = {r["unified_id"]: (r["x"], r["y"]) for r in start.collect()}
    assert len(placed) == len(clusters) and np.isfinite(list(placed.values())).all()
    assert kept_neighbours(placed, found(knn)) > kept_neighbours(flat, found(knn))


def test_the_map_does_not_depend_on_partitions(spark, clusters):
    small = clusters[::4]
    one = project(frame(spark, small), epochs=3)
    two = project(frame(spark, small).repartition(5), epochs=3)
    rounded = [F.col("unified_id"), F.round("x", 5), F.round("y", 5)]
    assert rows(one.select(*rounded)) == rows(two.select(*rounded))


def test_unknown_method(spark, clusters):
    with pytest.raises(ValueError):
        project(frame(spark, clusters), method="other")
