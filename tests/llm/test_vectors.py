"""Lattice points and near-duplicate vectors against brute force."""

import itertools
import math

import numpy as np
import pytest

from threadloom.llm import lattice

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.95):
    """(vec_id, links, component) of usable rows by comparing all of them."""
    fine = [(i, np.array(v, float)) for i, v in rows if v and i is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    n = len(fine)
    near = [[False] * n for _ in range(n)]
    for (a, (_, x)), (b, (_, y)) in itertools.combinations(enumerate(fine), 2):
        if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
            near[a][b] = near[b][a] = True
    component = [i for i, _ in fine]
    for _ in range(n):
        component = [min([component[a]] + [component[b] for b in range(n) if near[a][b]]) for a in range(n)]
    return {i: (sum(near[a]), component[a]) for a, (i, _) in enumerate(fine)}


def clustered(seed, clusters, size, spread, dims=16):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(clusters):
        centre = rng.standard_normal(dims)
        out += [(centre + spread * rng.standard_normal(dims)).astype(np.float32).tolist() for _ in range(size)]
    return out


def test_shortest_vectors_and_decoding():
    short = lattice.shortest_vectors()
    assert len({tuple(v) for v in short}) == 240 and np.allclose((short**2).sum(1), 2)
    points = np.vstack([np.zeros((1, 8)), short, 2 * short, short[:100] + short[50:150]])
    assert np.allclose(lattice.nearest_points(points), points)
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (400, 8))
    lot = np.vstack([np.zeros((1, 8)), short, *[short + v for v in short]])
    best = np.concatenate([((x[i : i + 20, None, :] - lot[None]) ** 2).sum(2).min(1) for i in range(0, 400, 20)])
    found = ((x - lattice.nearest_points(x)) ** 2).sum(1)
    assert (found <= best + 1e-9).all() and found.max() <= 1


@pytest.mark.parametrize("block", [8, 1024])
def test_matches_brute_force(spark, block):
    vectors = clustered(1, 25, 6, 0.04) + clustered(2, 1, 40, 0.05) + clustered(3, 10, 2, 0.2)
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)] + [(2000, [2 * x for x in rows[5][1]])]  # copies, and one of another length
    got = lattice.near_vectors(spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA), block=block).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    right = sum((r.n_links, r.component_id) == want[r.vec_id] for r in got)
    assert right >= 0.97 * len(rows)
    assert all(r.n_links <= want[r.vec_id][0] for r in got)  # nothing below the threshold, nothing counted twice
    assert sum(r.n_links for r in got) >= 0.97 * sum(n for n, _ in want.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_many_tables_find_everything_once(spark):
    rows = [(i, v) for i, v in enumerate(clustered(7, 12, 8, 0.05))]
    want = brute(rows)
    got = lattice.near_vectors(spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA), tables=10, probes=24, block=8).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]), (None, good), (7, good), (8, good), (8, good), (9, good + [0.0])]
    got = lattice.near_vectors(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert all(by[i] == [(0, i, True)] for i in (1, 2, 3, 4, 5, 6, 9))
    assert by[None] == [(0, None, True)] and by[7] == [(2, 7, True)] and by[8] == [(2, 7, False)] * 2
    assert lattice.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_near_the_threshold(spark):
    """Pairs at a cosine of 0.95 to 0.97 in 64 dimensions, among others that are apart."""
    rng = np.random.default_rng(12)
    first = rng.standard_normal((900, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    aside = rng.standard_normal((900, 64))
    aside -= (aside * first).sum(1, keepdims=True) * first
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = rng.uniform(0.951, 0.97, (900, 1))
    second = cosine * first + np.sqrt(1 - cosine**2) * aside
    x = np.vstack([first, second, rng.standard_normal((600, 64))]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    got = {r.vec_id: r.n_links for r in lattice.near_vectors(table).collect()}
    exact = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = ((exact @ exact.T) >= 0.95).sum(1) - 1
    found = np.array([got[i] for i in range(len(x))])
    assert want.sum() >= 1800 and (found <= want).all() and found.sum() >= 0.97 * want.sum()
