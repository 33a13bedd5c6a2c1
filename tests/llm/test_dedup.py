"""Exact and near duplicates of texts, and components."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.cases import ROWS, clashing_docs, no_docs, odd_docs
from threadloom.llm import exact, simhash
from threadloom.llm.blocks import forest
from threadloom.llm.components import components


def brute_groups(rows):
    """Exact groups in plain Python: (doc_id, keep_id, group_size, sha) of each row."""
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append(row)
    out = []
    for plain, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], keep[0], len(members), hashlib.sha256(plain.encode()).hexdigest()) for r in members]
    return Counter(out)


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(values, radius):
    """Of distinct values, the smallest one reachable over links of at most ``radius`` bits."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and bin(a ^ b).count("1") <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_exact_groups_match_brute_force(spark):
    got = exact.exact_groups(odd_docs(spark)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_groups(ROWS)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({r.text_sha256: 1 for r in got})  # repeated rows included
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies_keeps_one_row_of_each_group(spark):
    kept = exact.drop_copies(clashing_docs(spark))
    assert kept.columns == clashing_docs(spark).columns
    plain = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert sorted(plain) == sorted({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in ROWS})
    assert sum(r.doc_id == 2 for r in kept.collect()) == 1  # repeated rows count once, the longest stays


def test_exact_of_nothing(spark):
    assert exact.exact_groups(no_docs(spark)).count() == 0
    assert exact.drop_copies(no_docs(spark)).count() == 0


def test_hot_copies_and_filter(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text number {i}", "en", "a", 1) for i in range(3000)]
    got = exact.exact_groups(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert {r.group_size for r in got if r.keep_id == 0} == {1000}
    assert sum(r.kept for r in got) == 2001


def test_filter_is_bounded():
    assert exact.filter_bits(0) == 1 << 16
    assert exact.filter_bits(1 << 20) == 1 << 24
    assert exact.filter_bits(10**12) == exact.MOST_BITS


def test_full_filter_only_costs_rows(spark, monkeypatch):
    monkeypatch.setattr(exact, "MOST_BITS", 64)
    got = exact.exact_groups(odd_docs(spark)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_groups(ROWS)


@pytest.mark.parametrize("text", [None, "", " \n ", "one", "One two", "a b c d", "a b c d e", "A B\tc  d E f g É Ä ß", "x " * 500 + "y z"])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) & (2**64 - 1) == brute_print(text)


def test_fingerprint_of_a_text_of_many_parts():
    text = " ".join(str(i * i % 9973) for i in range(140_000))
    assert simhash.fingerprint_of(text) & (2**64 - 1) == brute_print(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_comparison_finds_every_pair(radius):
    rng = np.random.default_rng(radius)
    values = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2)
    for i in range(150):  # half of them near another
        flips = rng.choice(64, rng.integers(0, 9), replace=False)
        values[150 + i] = values[i] ^ np.uint64(sum(1 << int(b) for b in flips))
    values[3] = 0
    starts = np.array([0, 1, 130, 131, 290])
    run = np.searchsorted(starts, np.arange(300), "right")
    want = {
        (a, b) for a in range(300) for b in range(a + 1, 300)
        if run[a] == run[b] and int(values[a] ^ values[b]).bit_count() <= radius
    }
    got = [(int(x), int(y)) for a, b in simhash.linked_pairs(values, starts, radius) for x, y in zip(a, b, strict=True)]
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("block,pieces", [(16, None), (2048, None), (2048, 7)])
def test_links_connect_what_brute_force_connects(spark, block, pieces):
    rng = random.Random(block)
    values = {0, 3, 7}
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 12])):
            values.add(v)
            for b in rng.sample(range(64), rng.choice([1, 2, 4, 5])):
                v ^= 1 << b
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r.node: r.root for r in components(simhash.links(frame, block=block, pieces=pieces)).collect()}
    want = brute_components(sorted(values), 4)
    groups = defaultdict(set)
    for v in values:
        s = v - (1 << 64) if v >> 63 else v
        groups[found.get(s, s)].add(want[v])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_near_duplicates(spark):
    got = simhash.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == len(ROWS)
    prints = {brute_print(r[1]) for r in ROWS}
    roots = brute_components(prints, 4)
    first = {}
    for row in ROWS:
        root = roots[brute_print(row[1])]
        ids = [x for x in (first.get(root), row[0]) if x is not None]
        first[root] = min(ids) if ids else None
    want = Counter((r[0], format(brute_print(r[1]), "016x"), first[roots[brute_print(r[1])]]) for r in ROWS)
    assert Counter(tuple(r) for r in got) == want


def test_keep_one(spark):
    kept = simhash.keep_one(clashing_docs(spark))
    assert kept.columns == clashing_docs(spark).columns
    groups = len(set(brute_components({brute_print(r[1]) for r in ROWS}, 4).values()))
    assert kept.count() == groups
    assert simhash.keep_one(no_docs(spark)).count() == 0


def test_components_of_chain_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 500)]
    links = chain + [(b, a) for a, b in chain[:5]] + star + [(1, 1), (None, 4), (5, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 500)]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    a, b = np.array([5, 3, 9, 1]), np.array([3, 9, 4, 0])
    assert forest(np.arange(10), a, b).tolist() == [0, 0, 2, 3, 3, 3, 6, 7, 8, 3]
