"""Language identification: Viterbi against brute force, scripts, odd rows, held-out accuracy."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import ROWS, clashing_docs, no_docs
from threadloom.llm import langid
from threadloom.llm.queries import op3_language


def brute_path(scores, penalty):
    best, path = -np.inf, None
    for labels in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        value = sum(scores[i, x] for i, x in enumerate(labels)) - penalty * sum(a != b for a, b in itertools.pairwise(labels))
        if value > best:
            best, path = value, labels
    return best, path


def value_of(scores, labels, penalty):
    return sum(scores[i, x] for i, x in enumerate(labels)) - penalty * sum(a != b for a, b in itertools.pairwise(labels))


@pytest.mark.parametrize("penalty", [0.5, 3.0, 8.0])
def test_viterbi_is_optimal(penalty):
    rng = np.random.default_rng(int(penalty * 10))
    lengths = [1, 2, 7, 3, 6, 1, 7]
    scores = -rng.exponential(4, (sum(lengths), 3))
    scores[3:6] = [[0, -9, -9], [-9, 0, -9], [-9, 0, -9]]
    starts = np.cumsum([0, *lengths[:-1]])
    labels = langid.viterbi(scores, starts, penalty)
    for a, n in zip(starts, lengths, strict=True):
        want, _ = brute_path(scores[a : a + n], penalty)
        assert value_of(scores[a : a + n], labels[a : a + n], penalty) == pytest.approx(want)
    assert len(langid.viterbi(np.zeros((0, 3)), np.zeros(0, np.int64), 1.0)) == 0


@pytest.fixture(scope="module")
def model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame(
        [(10_000 + i, f"Это простой русский текст номер и он говорит о погоде {'слово ' * i}", "ru") for i in range(20)], "doc_id long, text string, lang string"
    )
    return langid.fit(docs.select("doc_id", "text", "lang").unionByName(extra))


def one(spark, model, text):
    return spark.createDataFrame([(text,)], "text string").select(
        langid.predict(F.col("text"), model).alias("p"), langid.spans(F.col("text"), model).alias("s")
    ).first()


def test_scripts_narrow_candidates(spark, model):
    assert model.languages == ("de", "en", "es", "fr", "ru")
    got = one(spark, model, "погода")
    assert got.p.lang == "ru" and got.p.score == 1.0
    assert one(spark, model, "the").p.lang != "ru"


def test_spans_of_a_mixed_text(spark, model, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) > 400")
    english = docs.filter("lang = 'en'").orderBy("doc_id").first().text[:300]
    german = docs.filter("lang = 'de'").orderBy("doc_id").first().text[:300]
    text = f"{english} 123 {german} -- Это русский текст о погоде"
    got = one(spark, model, text)
    assert [s.lang for s in got.s] == ["en", "de", "ru"]
    assert text[got.s[0].begin : got.s[0].end] in english + " " and text[got.s[2].begin :] == "Это русский текст о погоде"
    assert abs(got.s[1].begin - len(english) - 5) < 12
    assert got.p.score < 0.6


@pytest.mark.parametrize("text", [None, "", "  ", "12 34 !!", "😀"])
def test_texts_without_letters(spark, model, text):
    got = one(spark, model, text)
    assert (got.p.lang, got.p.score, got.s) == ("und", 0.0, [])


def test_letters_of_an_unseen_script_get_some_language(spark, model):
    assert one(spark, model, "გამარჯობა").p.lang in model.languages


def test_long_text_among_short_ones(spark, model, monkeypatch):
    frame = clashing_docs(spark).select("doc_id", langid.predict(F.col("text"), model).alias("p"))
    whole = {(r.doc_id, r.p.lang) for r in frame.collect()}
    assert len(frame.collect()) == len(ROWS) and (6, "de") in whole and (7, "und") in whole and (3, "und") in whole
    monkeypatch.setattr(langid, "CHARS_AT_ONCE", 50)
    again = clashing_docs(spark).select("doc_id", langid.predict(F.col("text"), model).alias("p"))
    assert {(r.doc_id, r.p.lang) for r in again.collect()} == whole


def test_nothing_to_learn_from(spark):
    empty = langid.fit(no_docs(spark))
    assert empty.languages == ()
    assert one(spark, empty, "some text").p.lang == "und"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = op3_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert held.n > 200 and held.a > 0.99
