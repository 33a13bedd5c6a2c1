"""Personal data: patterns against plain regular expressions, the tagger against enumeration, gradients and held-out spans."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import clashing_docs, no_docs, odd_docs
from threadloom.llm import pii, queries
from threadloom.llm.tagger import PAD, Tagger, classes_of, crf_gradients, train, viterbi

# The four patterns as stated, matched the plain way.
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c.isdigit()]
            doubled = [(2 * d - 9 if d > 4 else 2 * d) if i % 2 else d for i, d in enumerate(reversed(digits))]
            fits = (
                True, all(int(x) <= 255 for x in m.group().split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                10 <= len(digits) <= 15,
            )[kind]
            if fits:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_are_those_of_the_plain_patterns():
    rng = random.Random(3)
    pieces = ["a", "b.c", "@", "@", ".", "-", "+", " ", "1", "22", "255", "256", "4111111111111111", "(49)", "0", "é", "x@y.z", "1.2.3.4", "5500 0000 0000 0004", "\n", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_patterns_take_long_texts():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + " (" * 150_000, "a@" * 150_000, "1 " * 150_000):
        pii.base_spans(text)
        pii.stretches(text)


def test_windows_cover_a_stretch():
    for size in (1, 63, 64, 65, 96, 200, 1000):
        starts = pii.windows(10, 10 + size)
        covered = {p for s in starts for p in range(s, s + pii.WINDOW)}
        assert set(range(10, 10 + size)) <= covered and all(b - a <= pii.STEP for a, b in zip(starts, starts[1:], strict=False))
        assert size <= pii.WINDOW or max(starts) + pii.WINDOW == 10 + size


def test_every_span_that_may_be_added_lies_in_a_stretch():
    rng = random.Random(5)
    pieces = [" jo", "at", " at ", "[at]", "@", " dot ", ".", " . ", "example", "com", " ", "x" * 30, "-", "4", "10.0", "(", ")", "{ dot }", "\n", "é", "+49 "]
    texts = ["write to jo at example.com today", "jo AT my-host . org", "a" * 90 + " at " + ("b" * 30 + ".") * 3 + "com"]
    texts += ["z " * 40 + "".join(rng.choice(pieces) for _ in range(rng.randrange(4, 14))) + " z" * 40 for _ in range(2000)]
    seen = 0
    for text in texts:
        held = pii.stretches(text)
        assert held == sorted(held) and all(b < c for (_, b), (c, _) in zip(held, held[1:], strict=False))
        for m in pii._LOOSE_EMAIL.finditer(text):
            seen += 1
            assert any(a <= m.start() and m.end() <= b for a, b in held), text
        for m in re.finditer(r"\d", text):
            assert any(a <= m.start() and m.end() <= b for a, b in held), text
    assert seen > 50
    for text in ("at-" * 100_000, "at a." * 60_000, "a at " * 60_000, "at-at." * 50_000):
        pii.stretches(text)


def test_crf_against_all_paths():
    rng = np.random.default_rng(0)
    scores, step, y = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3)), rng.integers(0, 3, (3, 5))
    value, _, _ = crf_gradients(scores, step, y)
    want, best = 0.0, []
    for b in range(3):
        paths = list(itertools.product(range(3), repeat=5))
        worth = [sum(scores[b, t, p[t]] for t in range(5)) + sum(step[i, j] for i, j in zip(p, p[1:], strict=False)) for p in paths]
        want += np.log(np.exp(worth).sum()) - worth[paths.index(tuple(y[b]))]
        best.append(paths[int(np.argmax(worth))])
    assert abs(value - want) < 1e-9
    assert viterbi(scores, step).tolist() == [list(p) for p in best]


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    model = Tagger.fresh(3, hidden=4, kind=np.float64)
    x, y = rng.integers(0, 100, (3, 7)), rng.integers(0, 3, (3, 7))
    _, grads = model.loss(x, y)
    for name, values in model.params.items():
        spots = [(int(x[0, 0]), 2), (int(x[1, 3]), 9)] if name[0] == "x" else [tuple(rng.integers(0, n) for n in values.shape) for _ in range(4)]
        for spot in spots:
            kept = values[spot]
            ends = []
            for by in (1e-5, -1e-5):
                values[spot] = kept + by
                ends.append(model.loss(x, y)[0])
            values[spot] = kept
            assert abs((ends[0] - ends[1]) / 2e-5 - grads[name][spot]) < 1e-6, name


def test_training_fits_and_classes():
    assert classes_of("a \té٣→")[:1] == [65] and classes_of("a \té٣→").tolist()[1:] == [0, 95, 96, 97, 98]
    x = np.full((40, 12), PAD)
    x[:, :10] = np.random.default_rng(2).integers(0, 90, (40, 10))
    y = (x > 45).astype(int) * (x < 95)
    model = Tagger.fresh(2, hidden=6)
    assert train(model, x, y, 60, batch=4) < 1.5 and (model.decode(x) == y).mean() > 0.97


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return pii.fit(docs.filter(~held)), [r.text for r in docs.filter(held & F.col("text").isNotNull()).select("text").collect()]


def test_held_out_variants_are_found_and_clean_texts_left_alone(learned):
    model, texts = learned
    rng, hits, all_of = random.Random(11), [0] * 4, [0] * 4
    for text in texts:
        for a, b, kind in pii.base_spans(text):
            for _ in range(2):
                other = pii.variants(kind, text[a:b], rng)
                start = min(a, 200)
                (got,) = pii.all_spans([text[max(0, a - 200) : a] + other + text[b : b + 200]], model)
                all_of[kind] += 1
                hits[kind] += any(k == kind and c <= start + 2 and d >= start + len(other) - 2 for c, d, k, _ in got)
    assert min(all_of) >= 30 and all(h >= 0.8 * n for h, n in zip(hits, all_of, strict=True)), (hits, all_of)
    found = pii.all_spans(texts, model)
    assert [[s[:3] for s in spans if s[3]] for spans in found] == [pii.base_spans(t) for t in texts]
    assert sum(not s[3] for spans in found for s in spans) <= 0.02 * len(texts)


def test_added_spans_do_not_touch_base_ones(learned):
    model, _ = learned
    text = "Write to jo.12 [at] mail3 [dot] example [dot] com or jo@x.org, server 10 . 20 . 30 . 40 and 10.20.30.40."
    (got,) = pii.all_spans([text], model)
    base = [s[:3] for s in got if s[3]]
    assert base == plain_spans(text) and any(not s[3] for s in got)
    for a, b, _, added in got:
        if not added:
            assert all(b <= x or y <= a for x, y, _ in base)


def test_query_and_odd_rows(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op12_pii"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    for r in got:
        base = plain_spans(docs[r.doc_id])
        names = [f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, k in base) for kind in range(4)]
        assert set(names) <= set(r.spans.split(",")) or not names
    for make in (odd_docs, clashing_docs):
        model = pii.fit(make(spark))
        rows = pii.find(make(spark), model).collect()
        assert model is None and len(rows) == 12 and all(r.spans == [] for r in rows)
    assert pii.fit(no_docs(spark)) is None and pii.find(no_docs(spark), None).count() == 0


def test_masking(spark):
    text = "é mail a@b.cd, then 10.0.0.1 and +1 (234) 567-8901."
    docs = spark.createDataFrame([(1, text), (2, None), (3, "nothing here")], "doc_id long, text string")
    found = docs.join(pii.find(docs, None), "doc_id").select("doc_id", pii.mask(F.col("text"), F.col("spans")).alias("masked"))
    assert {r.doc_id: r.masked for r in found.collect()} == {1: "é mail <email>, then <ip> and <phone>.", 2: "", 3: "nothing here"}
