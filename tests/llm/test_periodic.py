"""Periodic runs against a search of every start and period in plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.cases import LONG, clashing_docs, no_docs, odd_docs
from threadloom.llm import periodic, queries


def brute_runs(words):
    """Every (start, end, period) by definition: maximal stretches for each period, smallest period of each kept."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                stretch = words[i : j + q]
                if not any(stretch[:-d] == stretch[d:] for d in range(1, q)):
                    found.append((i, j + q, q))
            i = max(j, i + 1)
    return sorted(found)


def brute_row(doc_id, text):
    words = [w for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    shown = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *shown, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_scales_leave_no_period_out():
    for longest in (24, 100, 5000, 200_000):
        reach = periodic.scales(longest)
        assert reach[0][2] <= 10 and reach[-1][0] >= longest // 3
        for (k, w, least), (_, _, after) in zip(reach, reach[1:], strict=False):
            assert w + k - 1 <= 2 * least and after <= k + 1


def test_minimizers_by_definition():
    hashes = np.random.default_rng(1).integers(0, 40, 300).astype(np.uint64)
    for w in (1, 2, 5, 9):
        want = {j + i for j in range(300 - w + 1) for i in range(w) if hashes[j + i] == hashes[j : j + w].min()}
        assert set(periodic.minimizers(hashes, w).tolist()) == want


def made(rng):
    """Texts with runs of every period, of nested ones, of few different words, and just too short."""
    texts = []
    for q in [*range(1, 40), 47, 55, 80, 121, 200]:
        for extra in (0, 1, -1, q):
            period = [f"p{rng.randrange(3 + q)}" for _ in range(q)]
            length = max(24, 3 * q) + extra
            run = [period[i % q] for i in range(length)]
            texts.append([f"x{rng.randrange(99)}" for _ in range(rng.randrange(30))] + run + [f"y{rng.randrange(9)}" for _ in range(rng.randrange(30))])
    inner = [f"i{rng.randrange(4)}" for _ in range(5)] * 6
    texts += [(inner + [f"t{k}"]) * 4 for k in range(3)]  # runs inside a run
    texts += [[rng.choice("ab") for _ in range(400)] for _ in range(10)] + [["a"] * 300, ["a", "b"] * 90 + ["a"] * 60 + ["b"] * 80]
    word = ["a"]
    for _ in range(9):
        word = word + [{"a": "b", "b": "a"}[x] for x in word]
    texts.append(word)
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 900:
        fib = fib[1], fib[1] + fib[0]
    texts.append(fib[1])
    return texts


@pytest.mark.parametrize("at_once", [1, 3000, 10**9])
def test_every_run_is_found(at_once):
    texts = [[w.encode() for w in t] for t in made(random.Random(4))]
    held, size, got = [], 0, []
    for i, words in enumerate(texts):
        held.append((i, words))
        size += len(words)
        if size >= at_once:
            got += periodic.search(held)
            held, size = [], 0
    got += periodic.search(held)
    assert sum(r[1] for r in got) > 150
    for i, words in enumerate(texts):
        runs = brute_runs(words)
        assert got[i] == periodic.describe(i, words, runs), (i, runs)


def test_query_over_whole_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_periodic"](spark, sf).collect()}
    small = [(i, t) for i, t in docs if len((t or "").split()) < 2500]
    assert len(got) == len(docs) and len(small) >= 0.95 * len(docs)
    assert all(got[i] == brute_row(i, t) for i, t in small)
    assert sum(r[1] > 0 for r in got.values()) >= len(docs) // 20


@pytest.mark.parametrize("make", [odd_docs, clashing_docs])
def test_odd_rows(spark, make):
    docs = make(spark)
    for planted in (False, True):
        got = sorted((tuple(r) for r in periodic.periodic_runs(docs, planted).collect()), key=repr)
        assert len(got) == docs.count()
        want = [(r.doc_id, r.text) for r in docs.collect() if r.text != LONG]
        short = [r for r in got if r[0] != 6]
        if planted:
            assert short == sorted((brute_row(i, t) for i, t in want), key=repr)
        else:
            empty = hashlib.sha256(b"").hexdigest()
            assert [r for r in short if r[0] == 3] == [(3, 0, None, None, None, None, empty, empty)]
            (repeated,) = [r for r in got if r[0] == 6]
            assert repeated[1:6] == (1, 0, 48_000, 12, 4_000_000)
    assert periodic.periodic_runs(no_docs(spark)).count() == 0
