"""Vectors, sentiment and keywords for items that lack them."""

from __future__ import annotations

import datetime as dt
import hashlib

import numpy as np
import pandas as pd
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import has_text, sentences, words
from threadloom.operators.skew import skew_join
from threadloom.session import cut

# The task recorded beside a vector, and how far back new items are looked for.
EMBEDDING_TASK = "CLUSTERING"
LOOKBACK = dt.timedelta(days=2)

# Characters of text in a task that counts pairs.
PORTION = 1 << 24
# Words, the most common ones, whose counts a task knows while it looks for keywords; bits of the filter of phrases at most, and a phrase.
COMMON = 1 << 19
MOST_BITS, BITS_PER_PHRASE = 1 << 25, 16
# Weights are compared with this much to spare, as they are rounded.
_SLACK = 1e-5

CACHE_COLUMNS = [
    "embeddings", "embedding_model_name", "embedding_task_type", "embedding_generated_at", "sentiment_score",
    "sentiment_magnitude",
]


def recently_loaded(loaded: Column, as_of: dt.datetime, lookback: dt.timedelta | None = LOOKBACK) -> Column:
    """Loaded within the lookback before ``as_of``; without a lookback everything qualifies (backfill)."""
    return F.lit(True) if lookback is None else loaded >= F.lit(as_of - lookback)


def incomplete(score: str, vector: str) -> Column:
    return F.col(score).isNull() | F.col(vector).isNull() | (F.size(vector) == 0)


def _gap(cache: DataFrame) -> Column:
    if "has_vector" in cache.columns:
        return F.col("sentiment_score").isNull() | ~F.coalesce("has_vector", F.lit(False))
    return incomplete("sentiment_score", "embeddings")


def pending_items(
    items: DataFrame, cache: DataFrame, as_of: dt.datetime, lookback: dt.timedelta | None = LOOKBACK,
    text_col: str = "primary_text",
) -> DataFrame:
    """(content_item_id, content) of recent items with text whose cache entry is missing or incomplete.

    Of the cache only the key and one flag travel to the join, never the vectors; a cache that stores ``has_vector``
    is not even read for them.
    """
    recent = items.filter(
        recently_loaded(F.col("record_load_timestamp"), as_of, lookback) & has_text(F.col(text_col))
    ).select("content_item_id", F.col(text_col).alias("content"))
    known = cache.select(F.col("unified_id").alias("content_item_id"), _gap(cache).alias("_gap"))
    return recent.join(known, "content_item_id", "left").filter(F.coalesce("_gap", F.lit(True))).drop("_gap")


# --- vectors ---


def fit_embedder(docs: DataFrame, dim: int = 256, text_col: str = "content") -> PipelineModel:
    """Hashed tf-idf of unit length. The fit is one pass that keeps a count per dimension."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", minTokenLength=1),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim),
            IDF(inputCol="_tf", outputCol="_tfidf"),
            Normalizer(inputCol="_tfidf", outputCol="_unit"),
            Normalizer(inputCol="_tf", outputCol="_unit_tf"),
        ]
    ).fit(docs)


def kept_embedder(docs: DataFrame, path: str, dim: int = 256, text_col: str = "content") -> PipelineModel:
    """The embedder saved at ``path``; the first call fits it on ``docs`` and saves it.

    Kept beside a cache, it makes the vectors of every later run comparable with those already there.
    """
    try:
        return PipelineModel.load(path)
    except PySparkException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    except Exception as error:  # how a missing model shows depends on the file system
        if not any(sign in str(error) for sign in ("does not exist", "No such file", "FileNotFound")):
            raise
    fit_embedder(docs, dim, text_col).write().save(path)
    return PipelineModel.load(path)


def embedder_name(model: PipelineModel) -> str:
    """Kind, dimension and a digest of the weights: vectors of different fits carry different names."""
    weights = next(stage for stage in model.stages if hasattr(stage, "idf")).idf.toArray()
    return f"hashed_tfidf_{len(weights)}_{hashlib.md5(weights.tobytes()).hexdigest()[:8]}"


def embed_text(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """(content_item_id, embeddings, embedding_status, embedding_model_name); the status is empty when all is well.

    A text whose words are in every document has no tf-idf left and keeps its plain word counts instead; only a
    text without words has no vector.
    """
    def nonzero(vector: Column) -> Column:
        return F.when(F.exists(vector, lambda x: x != 0), vector)

    embedded = model.transform(docs).select(
        "content_item_id",
        F.coalesce(nonzero(vector_to_array("_unit")), nonzero(vector_to_array("_unit_tf"))).alias("embeddings"),
    )
    return embedded.withColumns({
        "embedding_status": F.when(F.col("embeddings").isNull(), "empty").otherwise(""),
        "embedding_model_name": F.lit(embedder_name(model)),
    })


# --- sentiment ---


def parse_sentiment(results: DataFrame, json_col: str = "result", status_col: str = "status") -> DataFrame:
    """Score and magnitude out of a provider's JSON; text that is no number gives NULL."""
    def number(path: str) -> Column:
        return F.get_json_object(json_col, path).try_cast("double")

    return results.select(
        "content_item_id",
        number("$.document_sentiment.score").alias("sentiment_score"),
        number("$.document_sentiment.magnitude").alias("sentiment_magnitude"),
        F.col(status_col).alias("sentiment_status"),
    )


def score_sentiment(docs: DataFrame, lexicon: DataFrame, text_col: str = "content", in_row: bool = True) -> DataFrame:
    """Sentiment from a (term, weight) table.

    A sentence scores the mean weight of its words; a document the mean over its sentences, within -1..1, with
    the sum of their absolute values as magnitude. ``in_row`` scores every document within its row, without any
    shuffle: the lexicon goes to the rows as one value, and looking a word up scans it, so this suits some hundred terms.
    With ``in_row=False`` words meet the lexicon in a join, at any size. Both give the same scores.
    """
    # One weight per term, so a term listed twice cannot count a word twice.
    weights = lexicon.groupBy("term").agg(F.max("weight").cast("double").alias("weight"))
    scored = _scored_in_row(docs, weights, text_col) if in_row else _scored_by_join(docs, weights, text_col)
    return scored.select(
        "content_item_id",
        F.when(F.col("_mean").isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_mean")))).alias("sentiment_score"),
        "sentiment_magnitude",
        F.when(F.col("_mean").isNull(), "empty").otherwise("").alias("sentiment_status"),
    )


def _scored_in_row(docs: DataFrame, weights: DataFrame, text_col: str) -> DataFrame:
    table = weights.agg(F.map_from_entries(F.collect_list(F.struct("term", "weight")))).scalar()

    def mean(tokens: Column) -> Column:
        total = F.aggregate(tokens, F.lit(0.0), lambda s, w: s + F.coalesce(F.try_element_at(F.col("_weights"), w), F.lit(0.0)))
        return total / F.size(tokens)

    tokens = F.filter(F.transform(sentences(F.col(text_col)), words), lambda t: F.size(t) > 0)
    means = F.transform("_tokens", mean)
    spoken = docs.select("content_item_id", tokens.alias("_tokens"), table.alias("_weights")).withColumn("_means", means)
    total = lambda of: F.aggregate("_means", F.lit(0.0), lambda s, m: s + of(m))
    some = F.size("_means") > 0
    return spoken.select(
        "content_item_id",
        F.when(some, total(lambda m: m) / F.size("_means")).alias("_mean"),
        F.when(some, total(F.abs)).alias("sentiment_magnitude"),
    )


def _scored_by_join(docs: DataFrame, weights: DataFrame, text_col: str) -> DataFrame:
    """Words meet the lexicon in a join; sums combine per sentence before they are shuffled."""
    spoken = docs.select("content_item_id", F.posexplode(sentences(F.col(text_col))).alias("sentence", "_text"))
    tokens = spoken.select("content_item_id", "sentence", F.explode(words(F.col("_text"))).alias("term"))
    per_sentence = (
        skew_join(tokens, weights, "term", "left")
        .groupBy("content_item_id", "sentence")
        .agg((F.coalesce(F.sum("weight"), F.lit(0.0)) / F.count(F.lit(1))).alias("mean"))
    )
    scored = per_sentence.groupBy("content_item_id").agg(
        F.avg("mean").alias("_mean"), F.sum(F.abs("mean")).alias("sentiment_magnitude")
    )
    return docs.select("content_item_id").join(scored, "content_item_id", "left")


def learn_lexicon(rated: DataFrame, prior: float = 500.0, least: float = 1.96, text_col: str = "content", score_col: str = "score") -> DataFrame:
    """(term, n_positive, n_negative, weight): words that tell texts rated above zero from those below.

    A word's log-odds in positive texts against negative ones, with ``prior`` words of the whole corpus' mix added to each
    side, over its standard error, gives z. Words of abs(z) of ``least`` or more get the weight z / (1 + abs(z)), within
    -1..1. Texts rated zero or not at all, and null texts, teach nothing. Words are counted by sums that combine before they
    shuffle; what is joined to them are two totals.
    """
    side = F.when(F.col(score_col) > 0, 1).when(F.col(score_col) < 0, -1).alias("_side")
    spoken = rated.select(side, F.explode(words(F.col(text_col))).alias("term")).filter(F.col("_side").isNotNull())
    counts = cut(spoken.groupBy("term").agg(F.count_if(F.col("_side") > 0).alias("n_positive"), F.count_if(F.col("_side") < 0).alias("n_negative")))
    totals = [counts.agg(F.sum(name).cast("double")).scalar() for name in ("n_positive", "n_negative")]
    mixed = prior * (F.col("n_positive") + F.col("n_negative")) / (totals[0] + totals[1])
    seen = [F.col(name) + mixed for name in ("n_positive", "n_negative")]
    odds = [F.log(s / F.when(total + prior - s > 0, total + prior - s)) for s, total in zip(seen, totals, strict=True)]
    z = (odds[0] - odds[1]) / F.sqrt(1 / seen[0] + 1 / seen[1])
    return counts.withColumn("_z", z).filter(F.abs("_z") >= least).select("term", "n_positive", "n_negative", (F.col("_z") / (1 + F.abs("_z"))).alias("weight"))


def sentiment_label(score: Column, threshold: float = 0.25) -> Column:
    """Positive, Negative or Neutral around a threshold; no score is an Error."""
    return (
        F.when(score.isNull(), "Error")
        .when(score >= threshold, "Positive")
        .when(score <= -threshold, "Negative")
        .otherwise("Neutral")
    )


# --- combination ---


def combine_enrichment(
    embedded: DataFrame, sentiment: DataFrame, as_of: dt.datetime, task: str = EMBEDDING_TASK,
) -> DataFrame:
    """Both providers' results side by side; an error of either drops the row, so it is tried again later.

    The model's name comes with the vectors, from the provider that made them; rows without a vector have none.
    """
    e = embedded.withColumn("_e", F.lit(True))
    s = sentiment.withColumn("_s", F.lit(True))
    fine = (F.length(F.coalesce("embedding_status", F.lit(""))) == 0) & (F.length(F.coalesce("sentiment_status", F.lit(""))) == 0)
    return (
        e.join(s, "content_item_id", "full")
        .filter(fine & (F.col("_e").isNotNull() | F.col("_s").isNotNull()))
        .select(
            F.col("content_item_id").alias("unified_id"),
            "embeddings",
            F.when(F.size("embeddings") > 0, F.col("embedding_model_name")).alias("embedding_model_name"),
            F.lit(task).alias("embedding_task_type"),
            F.lit(as_of).cast("timestamp").alias("embedding_generated_at"),
            "sentiment_score",
            "sentiment_magnitude",
        )
    )


# --- keywords ---


def _adjacent(spoken: DataFrame, values: str, *kept: str) -> DataFrame:
    """(``kept``, _first, _second): each value of the list ``values`` with the next one, in a row of its own."""
    beside = F.arrays_zip(F.col(values).alias("a"), F.slice(values, 2, F.size(values)).alias("b"))
    met = spoken.select(*kept, F.explode(beside).alias("_p")).filter("_p.b IS NOT NULL")
    return met.select(*kept, F.col("_p.a").alias("_first"), F.col("_p.b").alias("_second"))


def _portions(docs: DataFrame, text_col: str) -> DataFrame:
    """The texts dealt over tasks of about ``PORTION`` characters, few enough that a task counts its distinct pairs in memory."""
    chars = docs.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()[0]
    return docs.select(text_col).repartition(max(1, -(-chars // PORTION)))


def _number(seed: int, word: Column) -> Column:
    return F.xxhash64(F.lit(seed), word)


def _telling_seed(ones: DataFrame, seed: int = 42) -> int:
    """The first seed from ``seed`` on that gives every word of ``ones(w)`` a number of its own."""
    n = ones.count()
    while ones.select(_number(seed, F.col("w")).alias("h")).distinct().count() < n:
        seed += 1
    return seed


def collocations(docs: DataFrame, least_count: int = 5, least: float = 0.5, text_col: str = "content") -> DataFrame:
    """(term, n, npmi): neighbouring words that occur together far more often than their own counts let expect.

    The measure is the mutual information of the two words over -log(p) of the pair, 1 for words that only occur together and
    0 for independent ones. Pairs are counted as two numbers, by a hash that is checked to tell all words apart; those below
    ``least_count`` are dropped, and the rest joined with their words and the counts of these; a word that begins most pairs
    is split by the join. Null and empty texts give nothing.
    """
    spoken = docs.select(words(F.col(text_col)).alias("_w"))
    ones = cut(spoken.select(F.explode("_w").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("c")))
    seed = _telling_seed(ones)
    numbered = _portions(docs, text_col).select(F.transform(words(F.col(text_col)), lambda w: _number(seed, w)).alias("_h"))
    twos = _adjacent(numbered, "_h").groupBy("_first", "_second").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)
    # A word of a pair occurs as often as the pair at least.
    known = ones.filter(F.col("c") >= least_count).withColumn("_h", _number(seed, F.col("w")))
    met = skew_join(twos, known.select(F.col("_h").alias("_first"), F.col("w").alias("_w1"), F.col("c").alias("_c1")), "_first")
    met = skew_join(met, known.select(F.col("_h").alias("_second"), F.col("w").alias("_w2"), F.col("c").alias("_c2")), "_second")
    total = F.log(ones.agg(F.sum("c").cast("double")).scalar())
    npmi = (F.log("n") + total - F.log("_c1") - F.log("_c2")) / (total - F.log("n"))
    return met.select(F.concat_ws(" ", "_w1", "_w2").alias("term"), "n", F.round(npmi, 6).alias("npmi")).filter(F.col("npmi") >= least)


def _commonest(ones: DataFrame, seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The numbers, in order, and counts of the words of ``ones(w, df)`` with the highest counts, at most COMMON; all others' counts are below the last value.

    It is a power of two, found by counting the words by the length of their counts in bits.
    """
    lengths = ones.groupBy(F.length(F.bin("df")).alias("bits")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("bits").desc()).collect()
    edge, many = 1 << (lengths[0]["bits"] if lengths else 0), 0
    for row in lengths:
        many += row["n"]
        if many > COMMON:
            break
        edge = 1 << (row["bits"] - 1)
    rows = ones.filter(F.col("df") >= edge).select(_number(seed, F.col("w")).alias("h"), "df").toArrow()
    numbers, counts = rows["h"].to_numpy(), rows["df"].to_numpy()
    order = np.argsort(numbers)
    return numbers[order], counts[order], edge


def _rivals(numbers: Column, k: int, total: int, common: tuple[np.ndarray, np.ndarray, int]) -> Column:
    """(at, tf): the place, from 0, and count of each word of a text that may be among the ``k`` of highest weight.

    A common word's weight is known, another one's lies between those of the least and the greatest count it can have. A word is
    left out if ``k`` others weigh more for certain. Words are told apart by their ``numbers``.
    """

    @F.pandas_udf("at array<int>, tf array<int>")
    def of(column: pd.Series) -> pd.DataFrame:
        known, counts, edge = common
        sizes = np.array([0 if x is None else len(x) for x in column], np.int64)
        word = np.concatenate([np.empty(0, np.int64), *[x for x in column if x is not None]])
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((word, row))
        row, word = row[order], word[order]
        starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (word[1:] != word[:-1]))[: len(row)])
        at = (np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order[starts]].astype(np.int32)
        tf = np.diff(np.append(starts, len(row))).astype(np.int32)
        row, word = row[starts], word[starts]
        low, high = np.ones(len(word)), np.full(len(word), edge - 1.0)
        if len(known):
            place = np.minimum(np.searchsorted(known, word), len(known) - 1)
            sure = known[place] == word
            low[sure] = high[sure] = counts[place[sure]]
        least, most = (tf * np.log((total + 1) / (df + 1)) for df in (high, low))
        begins = np.searchsorted(row, np.arange(len(sizes) + 1))
        enough = np.flatnonzero(np.diff(begins) >= k)
        bound = np.full(len(sizes), -np.inf)
        bound[enough] = least[np.lexsort((-least, row))][begins[enough] + k - 1]
        keep = most >= bound[row] - _SLACK
        cuts = np.searchsorted(row[keep], np.arange(1, len(sizes)))
        if not len(sizes):
            return pd.DataFrame({"at": [], "tf": []})
        return pd.DataFrame({"at": np.split(at[keep], cuts), "tf": np.split(tf[keep], cuts)})

    return of(numbers)


def _pair_number(first: Column, second: Column) -> Column:
    return F.xxhash64(first, second)


def _phrase_filter(phrases: DataFrame, seed: int) -> np.ndarray:
    """The 64-bit words of a Bloom filter of the numbers of ``phrases(term)`` of two words. Its size is bounded; a full one lets more pairs through."""
    size = min(MOST_BITS, 1 << max(10, (BITS_PER_PHRASE * phrases.count() - 1).bit_length())) // 64
    parts = F.split("term", " ")
    number = _pair_number(_number(seed, F.element_at(parts, 1)), _number(seed, F.element_at(parts, 2)))
    bit = lambda away: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright("h", away).bitwiseAND(F.lit(63)).cast("int"))
    slots = phrases.filter(F.size(parts) == 2).select(number.alias("h")).groupBy(F.pmod("h", F.lit(size)).alias("slot"))
    rows = slots.agg(F.bit_or(bit(40).bitwiseOR(bit(50))).alias("mask")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows["slot"].to_numpy()] = rows["mask"].to_numpy()
    return out


def _maybe_phrases(numbers: Column, table: np.ndarray) -> Column:
    """The places, from 0, of words that may begin a phrase with the next one: all that do, and few others."""
    many = F.greatest(F.size(numbers) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(numbers, 1, many), F.slice(numbers, 2, many), _pair_number)

    @F.pandas_udf("array<int>")
    def of(column: pd.Series) -> pd.Series:
        def places(pair: np.ndarray | None) -> np.ndarray:
            pair = np.empty(0, np.int64) if pair is None else pair
            mask = (np.int64(1) << (pair >> 40 & 63)) | (np.int64(1) << (pair >> 50 & 63))
            return np.flatnonzero(table[pair % len(table)] & mask == mask).astype(np.int32)

        return pd.Series([places(pair) for pair in column], dtype=object)

    return of(pairs)


def _phrases_in(spoken: DataFrame, phrases: DataFrame, seed: int) -> DataFrame:
    """(content_item_id, term, tf): the ``phrases`` in ``spoken(content_item_id, _w, _h)``; only pairs that their filter lets through meet them."""
    maybe = spoken.select("content_item_id", "_w", _maybe_phrases(F.col("_h"), _phrase_filter(phrases, seed)).alias("_at"))
    pair = F.transform("_at", lambda at: F.concat_ws(" ", F.get("_w", at), F.get("_w", at + 1)))
    met = skew_join(maybe.select("content_item_id", F.explode(pair).alias("term")), phrases, "term")
    return met.groupBy("content_item_id", "term").agg(F.count(F.lit(1)).cast("int").alias("tf"))


def keywords(docs: DataFrame, k: int = 5, text_col: str = "content", phrases: DataFrame | None = None) -> DataFrame:
    """The ``k`` words of highest tf-idf per item, best first; equal weights go by the word.

    With ``phrases(term)``, such as :func:`collocations` finds, phrases count as terms beside their words. Pairs of words that a filter
    of the phrases lets through meet them in a join.

    All words are counted first, by sums that combine before they shuffle. Then a word is counted within its row, and only those
    of a row that may be among its ``k`` best are joined with their counts, as (item, word, count) rows; no text is shuffled.
    A word that is in most items is split by the join.
    """
    listed = docs.select("content_item_id", words(F.col(text_col)).alias("_w"))
    ones = cut(listed.select(F.explode(F.array_distinct("_w")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df")))
    seed = _telling_seed(ones)
    total = docs.count()
    spoken = listed.select("*", F.transform("_w", lambda w: _number(seed, w)).alias("_h"))
    rivals = spoken.select("content_item_id", "_w", _rivals(F.col("_h"), k, total, _commonest(ones, seed)).alias("_r"))
    counted = F.zip_with("_r.at", "_r.tf", lambda at, n: F.struct(F.get("_w", at).alias("term"), n.alias("tf")))
    tf = cut(rivals.select("content_item_id", F.explode(counted).alias("c")).select("content_item_id", "c.term", "c.tf"))
    counts = ones.select(F.col("w").alias("term"), "df")
    if phrases is not None:
        more = cut(_phrases_in(spoken, cut(phrases.select("term").distinct()), seed))
        tf = tf.unionByName(more)
        counts = counts.unionByName(more.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    # Words of one item are left out. What remains is written, so a table that may be broadcast is known to be small before any
    # word is shuffled; then each task passes on k words an item.
    df = cut(counts.filter("df > 1"))
    weight = F.round(F.col("tf") * F.log((total + 1) / (F.coalesce("df", F.lit(1)) + 1)), 6)
    best = Window.partitionBy("content_item_id").orderBy(F.col("weight").desc(), "term")
    ranked = (
        skew_join(tf, df, "term", "left")
        .select("content_item_id", "term", weight.alias("weight"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
    )
    return ranked.groupBy("content_item_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]).alias("keyword_list")
    )
