"""License scans and the quality classifier."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import ROWS, clashing_docs, no_docs
from threadloom.llm import licenses, quality
from threadloom.llm.queries import op7_quality


def grams(text):
    words = re.sub(r"[^\w]|_", " ", text.lower()).split()
    return Counter(zip(words, words[1:], strict=False))


def brute_scan(rows, least=0.8):
    """Every window of each template's size, shorter ones at the end of a text included."""
    out = Counter()
    for doc_id, text in rows:
        words = re.sub(r"[^\w]|_", " ", (text or "").lower()).split()
        ours = list(zip(words, words[1:], strict=False))
        for name, texts in licenses.TEMPLATES.items():
            found = []
            for theirs in map(grams, texts):
                for start, first in enumerate(ours):
                    if first in theirs:
                        window = ours[start : start + theirs.total()]
                        dice = 2.0 * (Counter(window) & theirs).total() / (len(window) + theirs.total())
                        found += [(start, start + len(window), dice)] * (dice >= least)
            reach, statements = 0, 0
            for start in sorted({f[0] for f in found}):
                statements += start >= reach
                reach = max(reach, *(f[1] for f in found if f[0] == start))
            if found:
                out[doc_id, name, round(max(f[2] for f in found), 9), statements] += 1
    return out


def scan_rows(spark, rows, templates=None):
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, license string, _n string, _at int")
    return Counter((r.doc_id, r.license, round(r.dice, 9), r.statements) for r in licenses.scan(docs, licenses.template_rows(spark, templates)).collect())


def test_scan_matches_brute_force(spark):
    mit, gpl, short = licenses.TEMPLATES["MIT"][3], licenses.TEMPLATES["GPL-3.0"][2], licenses.TEMPLATES["CC-BY-NC-4.0"][0]
    wrapped = mit.replace(" ", "\n", 1).replace("to deal", "\nto deal").replace("merge,", "merge,\n")
    rows = [
        (1, f"Some words.\n{short}\nMore words."), (2, f"code\n\n{wrapped}\n\nmore code"), (3, gpl.upper()), (4, None), (5, ""), (6, "license"),
        (7, gpl.replace("either version 3", "version 3")), (8, (short + "\n") * 50), (9, "under the " * 40), (9, short), (9, short), (10, mit + " " + mit),
        (None, short), (11, "the quick brown fox " * 5000 + short), (12, " ".join(gpl.split()[:30])), (13, " ".join(gpl.split()[-25:])),
    ]
    got = scan_rows(spark, rows)
    assert got == brute_scan(rows)
    assert (1, "CC-BY-NC-4.0", 1.0, 1) in got and (2, "MIT", 1.0, 1) in got and got[9, "CC-BY-NC-4.0", 1.0, 1] == 2
    assert (8, "CC-BY-NC-4.0", 1.0) in {g[:3] for g in got} and (11, "CC-BY-NC-4.0", 1.0, 1) in got


def test_statements_within_other_words(spark):
    comment = "\n".join(f" * {line}" for line in licenses.WHOLE["BSD-3-Clause"].split("\n"))
    rows = [
        (1, "Licensed under the MIT License. See the LICENSE file for details."), (2, "Copyright (c) 2020 Jane Doe. Released under the MIT License."),
        (3, "This page and all that is on it is licensed under the Apache License, Version 2.0. Other terms hold for pictures, which belong to their makers."),
        (4, f"/*\n * Copyright 2021 Jane Doe\n *\n{comment}\n */\nint main() {{ return 0; }}"), (5, "Licensed as the law under which the city stands demands."),
    ]
    got = scan_rows(spark, rows)
    assert got == brute_scan(rows)
    assert {g[:3] for g in got} == {(1, "MIT", 1.0), (2, "MIT", 1.0), (3, "Apache-2.0", 1.0), (4, "BSD-3-Clause", 1.0)}


def test_scan_of_odd_rows(spark):
    assert licenses.scan(clashing_docs(spark).withColumn("license", F.lit("x")), licenses.template_rows(spark)).count() == 0
    own = licenses.template_rows(spark, {"own": [ROWS[1][1]]})
    got = Counter((r.doc_id, r.dice, r.statements) for r in licenses.scan(clashing_docs(spark), own).collect())
    assert got == Counter({(1, 1.0, 1): 1, (2, 1.0, 1): 2})


def test_scan_of_nothing(spark):
    assert licenses.scan(no_docs(spark), licenses.template_rows(spark)).count() == 0
    assert licenses.scan(clashing_docs(spark), licenses.template_rows(spark, {})).count() == 0


def test_strength():
    assert quality.strength(0.0, 10, 1000, 1e5, 0.5) == quality.MOST_STRENGTH
    assert quality.strength(5.0, 1, 1000, 1e6, 0.5) == quality.MOST_STRENGTH
    loose, tight = (quality.strength(x, 20, 2000, 2e5, 0.5) for x in (40.0, 300.0))
    assert 1 <= tight < loose < quality.MOST_STRENGTH


def site_rows(bad_host_rate):
    """Texts that tell nothing; hosts that differ."""
    rows, labels = [], []
    for i in range(2000):
        host = f"h{i % 10}"
        rows.append((i, f"plain words number {i % 7}", "en", host, 1))
        if i % 3 == 0:
            labels.append((i, float(i % 100 >= (bad_host_rate if host == "h0" else 5))))
    rows += [(5000, "plain words number 1", "en", "rare", 1), (5001, "plain words number 1", "en", "h0", 1)]
    return rows, [*labels, (5000, 0.0)]


def test_sites_shrink_toward_the_prior(spark):
    rows, labels = site_rows(90)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality.score(docs, spark.createDataFrame(labels, "doc_id long, label double"), F.col("source"), F.col("lang")).collect()}
    assert len(got) == len(rows)
    assert got[5001].path_score < got[1].path_score  # a bad host lowers a page without a label
    assert got[5001].score < got[5001].text_score < got[1].score + 0.05
    assert abs(got[5000].path_score - sum(r.text_score for r in got.values()) / len(got)) < 0.2  # one row moves little


def test_posteriors_match_brute_force(spark):
    rows, labels = site_rows(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = quality.score(docs, spark.createDataFrame(labels, "doc_id long, label double"), F.col("source"), F.col("lang")).collect()
    truth, host = dict(labels), {r[0]: r[3] for r in rows}
    evidence = {r.doc_id: truth.get(r.doc_id, r.text_score) for r in got}
    mean = sum(evidence.values()) / len(evidence)
    sums, counts = Counter(), Counter()
    for i, e in evidence.items():
        sums[host[i]] += e
        counts[host[i]] += 1
    between = sum(counts[h] * (sums[h] / counts[h] - mean) ** 2 for h in counts)
    k = quality.strength(between, len(counts), len(evidence), sum(n * n for n in counts.values()), mean)
    for r in got[:300]:
        h = host[r.doc_id]
        assert r.host_score == pytest.approx((sums[h] - evidence[r.doc_id] + k * mean) / (counts[h] - 1 + k), abs=2e-3)


def test_odd_rows_and_labels(spark):
    labels = spark.createDataFrame([(1, 1.0), (1, 0.0), (2, None), (None, 1.0), (6, 1.0), (7, 0.0), (99, 1.0)], "doc_id long, label double")
    docs = clashing_docs(spark)
    got = quality.score(docs, labels, F.col("source"), F.col("lang")).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    assert all(r.score == 0 and not r.kept for r in got if r.doc_id in (3, 4, 5))
    assert all(0 <= r.score <= 1 for r in got)
    none = labels.limit(0)
    assert quality.score(docs, none, F.col("source"), F.col("lang")).count() == len(got)
    assert quality.score(docs, labels.filter("label = 1"), F.col("source"), F.col("lang")).count() == len(got)
    assert quality.score(no_docs(spark), labels, F.col("source"), F.col("lang")).count() == 0


def test_urls(spark):
    row = spark.sql("SELECT 'HTTP://Host.example:80/a/b?c#d' AS u").select(quality.url_host(F.col("u")).alias("h"), quality.url_path(F.col("u")).alias("p")).first()
    assert tuple(row) == ("host.example", "a")


def test_labels_are_predicted(spark):
    folder = "/root/testdata/sf0.1"
    got = op7_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    right = got.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int")).alias("a")).first().a
    assert right > 0.9
