import datetime as dt
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import final_plan, rows
from threadloom.functions.vectors import norm
from threadloom.operators import enrich as en
from threadloom.plans.enrichment import enrich

ITEMS = "content_item_id string, primary_text string, record_load_timestamp timestamp"
CACHE = "unified_id string, embeddings array<double>, sentiment_score double"
NOW = dt.datetime(2024, 3, 1)


def item(i, text="some text", days=0.0):
    return (i, text, None if days is None else NOW - dt.timedelta(days=days))


def test_pending_takes_missing_and_incomplete(spark):
    items = spark.createDataFrame([item(i) for i in "abcdef"], ITEMS)
    cache = spark.createDataFrame(
        [("a", [1.0], 0.1), ("b", None, 0.1), ("c", [], 0.1), ("d", [1.0], None), ("e", [1.0], 0.0)], CACHE
    )
    assert rows(en.pending_items(items, cache, NOW), "content_item_id") == [("b",), ("c",), ("d",), ("f",)]


def test_pending_needs_recent_items_with_text(spark):
    items = spark.createDataFrame(
        [item("edge", days=2), item("old", days=2.1), item("undated", days=None), item("blank", " \t"), item("none", None)], ITEMS
    )
    cache = spark.createDataFrame([], CACHE)
    assert rows(en.pending_items(items, cache, NOW), "content_item_id") == [("edge",)]
    assert rows(en.pending_items(items, cache, NOW, lookback=None), "content_item_id") == [("edge",), ("old",), ("undated",)]


def test_pending_moves_no_vectors(spark, tmp_path):
    spark.createDataFrame([("a", [1.0], 0.1)], CACHE).write.parquet(str(tmp_path / "c"))
    items = spark.createDataFrame([item("a")], ITEMS)
    plan = en.pending_items(items, spark.read.parquet(str(tmp_path / "c")), NOW)._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan.split("Exchange")
    assert all("embeddings" not in part.split("\n")[0] for part in before_exchange[1:])


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "content_item_id string, content string")


def test_embedding(spark):
    given = docs(spark, "red green", "green blue blue", "...", "red green")
    model = en.fit_embedder(given, dim=64)
    got = en.embed_text(given, model)
    assert rows(got.select("content_item_id", "embedding_status", F.round(norm(F.col("embeddings")), 9))) == [
        ("d0", "", 1.0), ("d1", "", 1.0), ("d2", "empty", None), ("d3", "", 1.0),
    ]
    vectors = {r[0]: r[1] for r in got.collect()}
    assert vectors["d0"] == vectors["d3"] and vectors["d0"] != vectors["d1"]
    assert "Python" not in final_plan(got)


def test_sentiment_of_sentences(spark):
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0), ("great", 9.0), ("good", 0.5)], "term string, weight double")
    got = en.score_sentiment(docs(spark, "Good day. Bad bad bad!", "great", "plain words", "?!", "Good\nGOOD x x"), lexicon)
    assert rows(got) == [
        ("d0", -0.25, 1.5, ""), ("d1", 1.0, 9.0, ""), ("d2", 0.0, 0.0, ""), ("d3", None, None, "empty"),
        ("d4", pytest.approx((1 + 1 / 3) / 2), pytest.approx(1 + 1 / 3), ""),
    ]


def test_sentiment_labels(spark):
    df = spark.createDataFrame([(s,) for s in (0.25, 0.24, -0.25, None)], "s double")
    assert [r[0] for r in df.select(en.sentiment_label(F.col("s"))).collect()] == ["Positive", "Neutral", "Negative", "Error"]


def test_parse_sentiment(spark):
    results = spark.createDataFrame(
        [("a", '{"document_sentiment": {"score": -0.5, "magnitude": 2}}', ""), ("b", "junk", "BAD"), ("c", '{"document_sentiment": {"score": "x"}}', "")],
        "content_item_id string, result string, status string",
    )
    assert rows(en.parse_sentiment(results)) == [("a", -0.5, 2.0, ""), ("b", None, None, "BAD"), ("c", None, None, "")]


def test_an_error_of_either_provider_drops_the_row(spark):
    e = spark.createDataFrame(
        [("both", [1.0], "", "m"), ("e_only", [1.0], None, "m"), ("e_bad", [1.0], "X", "m"), ("s_bad", [1.0], "", "m")],
        "content_item_id string, embeddings array<double>, embedding_status string, embedding_model_name string",
    )
    s = spark.createDataFrame(
        [("both", 0.1, 1.0, ""), ("s_only", 0.2, 1.0, ""), ("e_bad", 0.3, 1.0, ""), ("s_bad", 0.4, 1.0, "Y")],
        "content_item_id string, sentiment_score double, sentiment_magnitude double, sentiment_status string",
    )
    got = en.combine_enrichment(e, s, NOW)
    assert rows(got, "unified_id", "embeddings", "sentiment_score", "embedding_model_name") == [
        ("both", [1.0], 0.1, "m"), ("e_only", [1.0], None, "m"), ("s_only", None, 0.2, None),
    ]


def test_keywords(spark):
    got = en.keywords(docs(spark, "apple apple pear the", "the pear", "the the", "!"), k=2)
    assert rows(got) == [("d0", ["apple", "pear"]), ("d1", ["pear", "the"]), ("d2", ["the"])]


def test_a_kept_embedder_stays(spark, tmp_path):
    first = en.kept_embedder(docs(spark, "good", "fine words"), str(tmp_path / "m"), dim=16)
    again = en.kept_embedder(docs(spark, "quite", "other texts"), str(tmp_path / "m"), dim=16)
    assert en.embedder_name(first) == en.embedder_name(again) != en.embedder_name(en.fit_embedder(docs(spark, "quite", "other"), dim=16))
    assert rows(en.embed_text(docs(spark, "fine"), first)) == rows(en.embed_text(docs(spark, "fine"), again))


def test_both_ways_of_scoring_agree(spark):
    given = docs(spark, "good. bad bad! so so. ?", "good good bad", None, "", "...", "neutral words only")
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -0.5), ("good", 0.2), ("so", 0.1)], "term string, weight double")
    rounded = lambda df: sorted((r[0], r[1] and round(r[1], 9), r[2] and round(r[2], 9), r[3]) for r in df.collect())
    assert rounded(en.score_sentiment(given, lexicon)) == rounded(en.score_sentiment(given, lexicon, in_row=False))
    with pytest.raises(ValueError, match="too large"):
        en.score_sentiment(given, spark.range(1001).selectExpr("cast(id as string) term", "1d weight"))


def test_no_text_is_shuffled_for_keywords(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(en.keywords(docs(spark, "apple apple pear the", "the pear")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("ExistingRDD" in line for line in plan.split("\n") if "content#" in line) and "Exchange" in plan


def test_enrich_twice_is_enrich_once(spark, tmp_path):
    items = spark.createDataFrame([item("a", "good"), item("b", "fine words"), item("c", "old", days=9), item("d", "?!")], ITEMS)
    lexicon = spark.createDataFrame([("good", 1.0)], "term string, weight double")
    model = en.fit_embedder(docs(spark, "good", "fine words"), dim=16)
    providers = (lambda d: en.embed_text(d, model), lambda d: en.score_sentiment(d, lexicon))
    root = str(tmp_path / "cache")
    first = rows(enrich(items, root, NOW, *providers))
    assert [r[0] for r in first] == ["a", "b"]
    later = NOW + dt.timedelta(hours=1)
    assert rows(enrich(items, root, later, *providers)) == first


def test_a_failing_provider_leaves_the_row_for_the_next_run(spark, tmp_path):
    items = spark.createDataFrame([item("a", "good")], ITEMS)
    model = en.fit_embedder(docs(spark, "good", "x"), dim=16)
    lexicon = spark.createDataFrame([("good", 1.0)], "term string, weight double")

    def quota(d):
        return en.score_sentiment(d, lexicon).withColumn("sentiment_status", F.lit("QUOTA"))

    root = str(tmp_path / "cache")
    assert enrich(items, root, NOW, lambda d: en.embed_text(d, model), quota).count() == 0
    assert enrich(items, root, NOW, lambda d: en.embed_text(d, model), lambda d: en.score_sentiment(d, lexicon)).count() == 1


def test_a_large_lexicon_is_scored_either_way(spark):
    lexicon = spark.range(3000).selectExpr("concat('w', id) as term", "(id % 5 - 2) / 2.0 as weight")
    given = spark.createDataFrame([("a", "w1 w2. w2999 other"), ("b", None), ("c", "none of them")], "content_item_id string, content string")
    assert rows(en.score_sentiment(given, lexicon)) == rows(en.score_sentiment(given, lexicon, in_row=False))


def test_a_learned_lexicon_scores_new_texts(spark):
    texts = [(f"t{i}", f"the {('good', 'fine')[i % 2] if i % 3 else ('bad', 'dull')[i % 2]} thing number {i}", 1.0 if i % 3 else -1.0) for i in range(300)]
    texts += [("z", "good good bad", 0.0), ("n", None, 1.0), ("u", "bad bad bad", None)]
    rated = spark.createDataFrame(texts, "content_item_id string, content string, score double")
    learned = {r.term: r for r in en.learn_lexicon(rated).collect()}
    assert {t: r.weight > 0 for t, r in learned.items()} == {"good": True, "fine": True, "bad": False, "dull": False}
    assert (learned["bad"].n_positive, learned["bad"].n_negative) == (0, 50)
    new = spark.createDataFrame([("p", "a fine day"), ("q", "dull, bad weather")], "content_item_id string, content string")
    scores = {r.content_item_id: r.sentiment_score for r in en.score_sentiment(new, en.learn_lexicon(rated), in_row=False).collect()}
    assert scores["p"] > 0 > scores["q"]
    assert en.learn_lexicon(rated.limit(0)).count() == 0
    assert en.learn_lexicon(rated.filter("content_item_id = 'n'")).count() == 0


def test_pairs_are_counted_by_numbers_that_tell_words_apart(spark, monkeypatch):
    """No pair is spelled out before it is counted; a seed under which two words share a number is not used."""
    given = docs(spark, *["new york is far, new york is big"] * 4, "a b a b a b a b a b a b", None, "", "one")
    found = en.collocations(given, least=-1.0)
    before, _, _ = found._jdf.queryExecution().optimizedPlan().toString().partition("posexplode")
    counted = [line for line in before.split("\n") if "Aggregate" in line and "_first" in line]
    assert counted and all("concat_ws" not in line for line in counted) and dict(found.dtypes)["term"] == "string"
    plain, number, tried = rows(found), en._number, []
    monkeypatch.setattr(en, "_number", lambda seed, w: tried.append(seed) or (F.length(w).cast("bigint") if seed == 42 else number(seed, w)))
    assert rows(en.collocations(given, least=-1.0)) == plain and set(tried) == {42, 43}
    monkeypatch.setattr(en, "PORTION", 40)
    assert en._portions(given, "content").rdd.getNumPartitions() > 3 and rows(en.collocations(given, least=-1.0)) == plain
    assert {r[0]: r[1] for r in plain} == {"new york": 8, "york is": 8, "a b": 6, "b a": 5}


def test_collocations_and_phrases_as_keywords(spark):
    texts = [(f"d{i}", f"New York has {i} the parks and the streets") for i in range(10)] + [("x", "york new"), ("y", None), ("z", ""), ("w", "one")]
    given = spark.createDataFrame(texts, "content_item_id string, content string")
    found = {r.term: (r.n, r.npmi) for r in en.collocations(given, least_count=5).collect()}
    assert found["new york"][0] == 10 and found["new york"][1] > 0.9
    assert "york new" not in found and all(n >= 5 and v >= 0.5 for n, v in found.values())
    lists = {r.content_item_id: r.keyword_list for r in en.keywords(given, k=20, phrases=en.collocations(given)).collect()}
    assert "new york" in lists["d3"] and "york" in lists["d3"] and "new york" not in lists["x"]
    assert set(lists) == {f"d{i}" for i in range(10)} | {"x", "w"}
    plain = {r.content_item_id: r.keyword_list for r in en.keywords(given, k=20).collect()}
    assert plain == {i: [t for t in terms if " " not in t] for i, terms in lists.items()}


def test_words_are_not_shuffled_to_meet_a_small_table(spark):
    given = docs(spark, "one two two", "two three", "three four one one", None)
    listed = en.keywords(given, k=2)
    assert "hashpartitioning(term" not in final_plan(listed)
    assert {r[0]: r[1] for r in listed.collect()} == {"d0": ["two", "one"], "d1": ["three", "two"], "d2": ["one", "four"]}


@pytest.mark.parametrize("common", [0, 6, 1000])
def test_few_words_of_an_item_meet_their_counts(spark, monkeypatch, common):
    """Words that cannot be among the best are neither written nor joined, however many words are known; the lists are those of a plain count."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["w%d" % min(rng.randrange(1, 40), rng.randrange(1, 40)), "rare%d" % rng.randrange(300), "new york"]) for _ in range(60)) for _ in range(40)]
    texts += ["", "...", None, "one", texts[0]]
    given = docs(spark, *texts)
    monkeypatch.setattr(en, "COMMON", common)
    written, cut = [], en.cut
    monkeypatch.setattr(en, "cut", lambda df: written.append(cut(df)) or written[-1])
    phrases = spark.createDataFrame([("new york",), ("york new",), ("not there",), ("one",), ("w1 w2 w3",), ("new york",)], "term string")
    for k, some in ((3, None), (4, phrases)):
        written.clear()
        got = {r.content_item_id: r.keyword_list for r in en.keywords(given, k, phrases=some).collect()}
        tf = {}
        for i, text in enumerate(texts):
            w = [x for x in re.split("[^a-z0-9]+", text or "") if x]
            pairs = [p for p in map(" ".join, zip(w, w[1:])) if some is not None and p in ("new york", "york new")]
            tf["d%d" % i] = Counter(w + pairs)
        df = Counter(t for c in tf.values() for t in c)
        weight = lambda n, t: round(n * math.log((len(texts) + 1) / (df[t] + 1)), 6)
        want = {i: sorted(c, key=lambda t: (-weight(c[t], t), t))[:k] for i, c in tf.items() if c}
        assert got == want
        counted = [t.count() for t in written if "tf" in t.columns and "content_item_id" in t.columns]
        assert counted and (common < 1000 or max(counted) < 0.7 * sum(map(len, tf.values())))
