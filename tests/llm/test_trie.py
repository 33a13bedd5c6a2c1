"""Tree contraction and the prefix trie against plain recursion."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from threadloom.llm import contraction, trie
from threadloom.llm.queries import table


def brute_totals(parents, values):
    children = {}
    for node, parent in parents.items():
        children.setdefault(parent, []).append(node)
    out = {}
    for node in sorted(parents, key=lambda n: -depth(parents, n)):
        own = children.get(node, [])
        out[node] = (len(own), sum(out[c][1] for c in own) + (not own), sum(out[c][2] for c in own) + (values[node] or 0))
    return out


def depth(parents, node):
    steps = 0
    while parents[node] is not None:
        node, steps = parents[node], steps + 1
    return steps


def shapes():
    rng = random.Random(2)
    yield {0: None}
    yield {i: i - 1 if i else None for i in range(70)}  # one chain
    yield {i: 0 if i else None for i in range(50)}  # a star
    yield {i: (i - 1) // 2 if i else None for i in range(63)}
    yield {i: rng.randrange(max(0, i - 3), i) if i else None for i in range(300)}  # deep and thin
    yield {i: rng.randrange(i) if i > 2 else None for i in range(200)}  # several roots
    comb = {0: None}
    for i in range(1, 120):
        comb[i] = i - 2 if i % 2 == 0 else max(0, i - 1)
    yield comb


def test_totals_of_every_shape(spark):
    """All shapes as one forest, its nodes named at random."""
    rng, parents = random.Random(6), {}
    for shape in shapes():
        first = len(parents)
        parents |= {n + first: None if p is None else p + first for n, p in shape.items()}
    names = list(range(1000, 1000 + len(parents)))
    rng.shuffle(names)
    values = {n: rng.choice([None, rng.randrange(100)]) for n in parents}
    rows = [(names[n], None if p is None else names[p], values[n]) for n, p in parents.items()]
    got = contraction.subtree_totals(spark.createDataFrame(rows, "node long, parent long, v long"), ["v"])
    want = brute_totals(parents, values)
    assert {r.node: (r.n_children, r.n_leaves, r.v) for r in got.collect()} == {names[n]: w for n, w in want.items()}


def test_no_tree(spark):
    assert contraction.subtree_totals(spark.createDataFrame([], "node long, parent long, v long"), ["v"]).count() == 0


def brute_trie(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    by = {c: [(r[2], r[3]) for r in sorted(t)] for c, t in by.items()}
    whole = {}
    for c, turns in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = by.get(c - c % 5, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)
    totals = {}
    for key in sorted(nodes, key=len, reverse=True):
        own = children.get(key, [])
        saved = (len(nodes[key]) - 1) * len(key[-1][1].encode()) if key else 0
        totals[key] = (sum(totals[k][0] for k in own) + (not own), sum(totals[k][1] for k in own) + saved)
    out = []
    for key, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(key))))
        parent = min(nodes[key[:-1]]) if key else None
        out.append((min(members), len(key), parent, len(members), len(children.get(key, [])), *totals[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def made(rng):
    """Conversations alike from the start, in parts, wholly; one of very many turns; odd rows."""
    rows = []
    for c in range(60):
        same = rng.choice([None, None, 7, 8])
        source = random.Random(same if same is not None else c + 100)
        rows += [(c, t, ("user", "assistant")[t % 2], f"t{source.randrange(3 if t < 4 else 50)} é") for t in range(rng.randrange(1, 12))]
    rows += [(61, t, "user", f"long {t}") for t in range(180)] + [(66, t, "user", f"long {t}") for t in range(175)]
    rows += [(70 + i, 0, "user", "the same") for i in range(30)]
    rows += [(200, None, None, None), (200, None, "a", None), (200, 3, "user", "x"), (200, 3, "user", "x"), (200, 3, "", "y"), (203, 1, "user", ""), (None, 1, "user", "lost")]
    rows += [(300, 0, "user", "z" * 300_000), (301, 0, "user", "z" * 300_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", ["8", "40"])
def test_trie_by_definition(spark, monkeypatch, partitions):
    monkeypatch.setattr(trie, "IDS_AT_ONCE", 4)
    rows = made(random.Random(int(partitions)))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false" if partitions == "40" else "true")
    try:
        conversations = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit("x")).withColumn("depth", F.lit(1)).withColumn("_block", F.lit(2))
        got = trie.prefix_trie(*trie.rebuilt(conversations))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_conversations(spark):
    assert trie.prefix_trie(*trie.rebuilt(spark.createDataFrame([], SCHEMA))).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert trie.prefix_trie(*trie.rebuilt(nobody)).count() == 0


def test_turnless_conversations_end_in_the_root(spark, sf):
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    got = trie.prefix_trie(*trie.rebuilt(spark.createDataFrame([(c, 0, "user", "only")], SCHEMA))).collect()
    assert [tuple(r)[:7] for r in got] == [(c, 0, None, 1, 0, 1, 0)] and got[0].ends_sha256 == hashlib.sha256(str(c).encode()).hexdigest()
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = trie.prefix_trie(*trie.rebuilt(table(spark, sf, "conversations")))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_trie(rows)
