"""Near duplicates by shingle overlap, against all pairs in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from threadloom.llm import overlap, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_kept(rows, least=0.8):
    """Ids that stay: the smallest of each group of linked texts."""
    sets = {}
    for i, text in rows:
        words = text.encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def edited(rng):
    """Texts with copies of one to many changed words around the limit, a common line, and a hot group."""
    word = lambda: f"w{rng.randrange(5000)}"
    rows, line = [], "this very common line stands in a lot of texts"
    for n in (3, 5, 6, 40, 80, 200, 400):
        for _ in range(4):
            base = [word() for _ in range(n)] + (line.split() if n > 5 else [])
            rows.append(base)
            for share in (0.005, 0.01, 0.02, 0.025, 0.03, 0.05):
                rows.append([word() if rng.random() < share else w for w in base])
    base = [word() for _ in range(120)]
    rows += [[word() if i == k else w for k, w in enumerate(base)] for i in range(100)]
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize(("block", "pairs"), [(16, 8), (2048, 8), (64, 0)])
def test_every_similar_pair_is_linked(spark, monkeypatch, block, pairs):
    """In small blocks, in whole ones with shingles dealt over tasks, and with sets in every block instead of pairs."""
    monkeypatch.setattr(overlap, "SAMPLE", 3)
    monkeypatch.setattr(overlap, "KEY_ROWS", 30 if block == 2048 else 100_000)
    monkeypatch.setattr(overlap, "PAIRS_PER_TEXT", pairs)
    monkeypatch.setattr(overlap, "FEW_TEXTS", 16 if pairs else 1)
    if not pairs:
        monkeypatch.setattr(overlap, "_stars", lambda rows, least: rows.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(1))
    monkeypatch.setattr(overlap.similar, "__defaults__", (0.8, 5, block))
    rows = edited(random.Random(5))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    want = brute_kept(rows)
    assert {r.doc_id for r in overlap.keep_one(docs).collect()} == want
    if block == 2048:
        assert {r.doc_id for r in simhash.keep_one(docs).collect()} != want


def test_near_dedup_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == brute_kept(rows)
