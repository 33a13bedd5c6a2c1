"""Mixing and packing."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import ROWS, clashing_docs, no_docs, odd_docs
from threadloom.llm import mixing, packing


def brute_targets(sizes, weights, share=1.5, most=2.0):
    """Reshare the excess by weight until no source is above."""
    target, full = dict.fromkeys(sizes, 0.0), set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full and sizes[s]]
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * left / total >= most * sizes[s]}
        if not over:
            return target | {s: most * sizes[s] for s in full} | {s: weights[s] * left / total for s in open_}
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 500, "c": 90, "d": 1, "e": 0}, {"a": 5}, {"a": 1000, "b": 1, "c": 1}, {"x": 30, None: 70}])
def test_targets(spark, sizes):
    weighted = mixing.cyclic_weights(spark.createDataFrame(list(sizes.items()), "source string, size long"))
    got = {r.source: (r.weight, r.target) for r in mixing.targets(weighted).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    assert [got[s][0] for s in order] == [(3.0, 1.0, 2.0)[i % 3] for i in range(len(order))]
    want = brute_targets(sizes, {s: w for s, (w, _) in got.items()})
    assert {s: pytest.approx(t) for s, t in want.items()} == {s: t for s, (_, t) in got.items()}


def test_mixture_takes_what_the_targets_say(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (i % 40), "en", ("hot", "hot", "b", "c", None)[i % 5], 1) for i in range(5000)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    got = mixing.mixture(docs).collect()
    taken, size = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        size[r.source] = r.target
        assert r.size == r.doc_id % 40 and r.taken <= 2 * r.size
    for source, target in size.items():
        assert taken[source] == pytest.approx(target, rel=0.06)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixture(docs.repartition(7)).collect())) if None not in size else True
    assert mixing.mix(docs).count() == sum(r.copies for r in got)


def test_mix_keeps_columns_and_takes_odd_rows(spark):
    mixed = mixing.mix(clashing_docs(spark))
    assert mixed.columns == clashing_docs(spark).columns
    want = Counter()
    for r in mixing.mixture(odd_docs(spark)).collect():
        want[(r.doc_id, r.source)] += r.copies
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +want
    words = Counter({r.doc_id: r.size for r in mixing.mixture(odd_docs(spark)).collect()})
    assert words[3] == 0 and words[4] == 0 and words[5] == 0
    assert words[6] == len(re.findall(r"[^\x20\x09-\x0D]+", ROWS[8][1]))


def test_mixing_nothing(spark):
    assert mixing.mixture(no_docs(spark)).count() == 0
    assert mixing.mix(no_docs(spark)).count() == 0


TEXTS = [
    "", " ", "a", "Hello world", "two  spaces and   three", "line\nline\n\nblank\n", " leading and trailing ", "tabs\tand\r\nends",
    "it's they're WE'LL don't", "naïve café 😀 数字 123 ４５", "a b c", "x" * 3000, "<|endoftext|> inside <|endoftext|>", "!!! ... ?a1b2", "\n", "a\n", "a \nb",
]


def test_encoder_gives_the_ids_of_the_tokenizer():
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder()
    for text in TEXTS + [" ".join(TEXTS)]:
        assert list(encoder.ids(text)) == full.encode(text, add_special_tokens=False).ids, text


def test_pieces(spark):
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, text, *_ in ROWS:
        ids = full.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[(doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b]))] += 1
    got = packing.pieces(clashing_docs(spark)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    assert packing.pieces(no_docs(spark)).count() == 0


def check_places(rows, capacities):
    """Gapless from 0, in every capacity; returns the number of sequences."""
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacities.tokens and len(parts) <= capacities.documents
        assert sum(n * n for _, n in parts) <= capacities.attention
    return len(held)


def best_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, left in enumerate(bins) if left >= n]
        if fitting:
            i = min(fitting, key=lambda i: bins[i])
            bins[i] -= n
        else:
            bins.append(capacity - n)
    return len(bins)


@pytest.mark.parametrize("capacities", [
    packing.Capacities(), packing.Capacities(rule="dot"), packing.Capacities(documents=3), packing.Capacities(attention=300_000 + 1024**2),
    packing.Capacities(documents=5, weights=(1.0, 0.2, 0.5), rule="dot"),
])
def test_pack(spark, capacities):
    rng = np.random.default_rng(5)
    lengths = [int(x) for x in np.concatenate([rng.integers(1, 1025, 700), rng.integers(1, 60, 1500), [1024] * 40, [300] * 900])]
    rows = spark.createDataFrame([(i, 0, n, i) for i, n in enumerate(lengths)], "doc_id long, piece int, length long, ids_crc32 long")
    packed = packing.pack(rows, capacities).collect()
    assert Counter(r.doc_id for r in packed) == Counter(range(len(lengths)))
    n = check_places(packed, capacities)
    if capacities == packing.Capacities():
        assert n <= best_fit_decreasing(lengths, 1024) + 1
    assert n >= -(-sum(lengths) // 1024)


def test_plan_moves_runs_not_pieces():
    few = packing.plan({100: 50, 1024: 3, 333: 8}, packing.Capacities())
    many = packing.plan({100: 50_000_000, 1024: 3_000_000, 333: 8_000_000}, packing.Capacities())
    assert len(many) <= len(few) + 20
    assert packing.plan({}, packing.Capacities()) == []
    with pytest.raises(ValueError):
        packing.plan({2000: 1}, packing.Capacities())


def test_packed_pieces_and_sequences(spark):
    packed = packing.packed_pieces(clashing_docs(spark))
    check_places(packed.collect(), packing.Capacities())
    assert packing.packed_pieces(no_docs(spark)).count() == 0
    whole = packing.pieces(odd_docs(spark))
    from threadloom.session import cut

    placed = packing.pack(cut(whole))
    for row in packing.sequences(placed).collect():
        assert len(row.ids) <= 1024
    assert sum(len(r.ids) for r in packing.sequences(placed).collect()) == sum(len(r.ids) for r in whole.collect())


def test_a_source_without_ids_meets_its_target(spark):
    rows = [(None, f"text {i} " + "w " * (i % 9), "en", "a", 1) for i in range(3000)] + [(i, "some more words", "en", "b", 1) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mixture(docs).filter("source = 'a'").selectExpr("sum(taken) AS taken", "max(target) AS target", "max(taken / size) AS most").first()
    assert abs(got.taken / got.target - 1) < 0.05 and got.most <= 2
    assert mixing.mix(docs).filter("doc_id IS NULL").count() == mixing.mixture(docs).filter("doc_id IS NULL").selectExpr("sum(copies) AS n").first().n
