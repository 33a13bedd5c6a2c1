"""Document quality by hierarchical empirical Bayes: text evidence combined with what is known of path and host."""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.skew import skew_join
from threadloom.session import cut

# The text classifier is fitted on about so many labelled rows, picked by a hash of their id; everything else covers all rows.
TRAIN_ROWS = 20_000
KEEP = 0.5
CLIP = 0.02
MOST_STRENGTH = 1e6
FEATURES = ["symbols", "capitals", "distinct", "word_length", "log_words"]


def features(text: Column) -> list[Column]:
    """Of the whole text: shares of symbols and capitals, share of distinct words, mean word length, log of the words.

    All are 0 for a null text or one without words.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chars = F.length(text)
    n = F.size(words)
    share = lambda x, of: F.coalesce(F.when(of > 0, x / of), F.lit(0.0))
    return [
        share(F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]+", "")), chars).alias("symbols"),
        share(chars - F.length(F.regexp_replace(text, r"\p{Lu}+", "")), chars).alias("capitals"),
        share(F.size(F.array_distinct(words)), n).alias("distinct"),
        share(chars, n).alias("word_length"),
        F.coalesce(F.log1p(n), F.lit(0.0)).alias("log_words"),
    ]


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _clip(p: Column) -> Column:
    return F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), p))


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Column:
    """The probability of good quality as an expression over FEATURES, learned from ``labelled(doc_id, label, ...)``.

    Without labels it is one half; with labels of one kind only it is their mean.
    """
    known = labelled.filter(F.col("label").isNotNull())
    n, good = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n:
        return F.lit(0.5)
    if good in (0, n):
        return F.lit(float(good / n))
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(min(1.0, rows / n) * (1 << 30)))
    table = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(picked.withColumn("y", (F.col("label") >= 0.5).cast("double")))
    model = LogisticRegression(featuresCol="x", labelCol="y", regParam=1e-3, maxIter=50).fit(table)
    total = F.lit(float(model.intercept))
    for name, weight in zip(FEATURES, model.coefficients, strict=True):
        total = total + F.lit(float(weight)) * F.col(name)
    return 1 / (1 + F.exp(-total))


def strength(between: float, groups: int, n: float, n_squared: float, mean: float) -> float:
    """How many rows the prior above is worth: from the spread of group means by the method of moments.

    ``between`` is the sum of n_g * (mean of g - mean above)^2. No spread beyond chance gives MOST_STRENGTH, so that groups
    tell nothing; a spread as wide as possible gives 1.
    """
    chance = mean * (1 - mean)
    room = n - n_squared / n if n else 0.0
    if groups < 2 or room <= 0 or chance <= 0:
        return MOST_STRENGTH
    share = max(0.0, (between - (groups - 1) * chance) / room) / chance
    return min(MOST_STRENGTH, max(1.0, 1 / share - 1)) if share > 0 else MOST_STRENGTH


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column, keep: float = KEEP) -> DataFrame:
    """(doc_id, text_score, host_score, path_score, score, kept), one row per row of ``docs(doc_id, text, ...)``.

    A row's evidence is its label (the mean of the non-null labels of its id in ``labels(doc_id, label)``) or else the text
    classifier's probability. Evidence is added up by path and by host over all rows. A host's posterior shrinks toward the
    mean of everything, a path's toward its host's, each by a strength estimated from the spread between groups, and a row's
    own evidence is taken out of both first. The log-odds of text and path are added, those of the overall mean taken off.

    Null hosts and paths are groups of their own. A text without words (or null) has score 0 and is not kept, but counts
    as evidence. Rows under one id share its label and are scored apart. Extra columns are read only by ``host`` and ``path``.
    """
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    base = docs.select("doc_id", key(host).alias("_host"), F.concat_ws("\n", key(host), key(path)).alias("_path"), *features(F.col("text")))
    table = cut(base)
    truth = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("label").alias("label"))
    table = skew_join(table, truth, "doc_id", "left")
    text_score = _clip(fit(table))
    table = cut(table.select("doc_id", "_host", "_path", (F.col("log_words") > 0).alias("_words"), text_score.alias("text_score"), F.coalesce("label", text_score).alias("_e")))

    paths = cut(table.groupBy("_path", "_host").agg(F.sum("_e").alias("_ps"), F.count(F.lit(1)).alias("_pn")))
    hosts = cut(paths.groupBy("_host").agg(F.sum("_ps").alias("_hs"), F.sum("_pn").alias("_hn")))
    all_s, all_n = hosts.agg(F.sum("_hs"), F.sum("_hn")).first()
    mean = min(1 - CLIP, max(CLIP, all_s / all_n)) if all_n else 0.5
    spread = F.col("_hn") * F.pow(F.col("_hs") / F.col("_hn") - mean, 2)
    row = hosts.agg(F.sum(spread), F.count(F.lit(1)), F.sum("_hn"), F.sum(F.pow("_hn", F.lit(2.0)))).first()
    host_strength = strength(row[0] or 0.0, row[1], row[2] or 0, row[3] or 0.0, mean)
    placed = skew_join(paths, hosts, "_host")
    spread = F.col("_pn") * F.pow(F.col("_ps") / F.col("_pn") - F.col("_hs") / F.col("_hn"), 2)
    row = placed.agg(F.sum(spread), F.count(F.lit(1)), F.sum("_pn"), F.sum(F.pow("_pn", F.lit(2.0)))).first()
    path_strength = strength(row[0] or 0.0, row[1], row[2] or 0, row[3] or 0.0, mean)

    joined = skew_join(table.drop("_host"), placed.drop("_host"), "_path")
    host_score = (F.col("_hs") - F.col("_e") + host_strength * mean) / (F.col("_hn") - 1 + host_strength)
    path_score = (F.col("_ps") - F.col("_e") + path_strength * F.col("host_score")) / (F.col("_pn") - 1 + path_strength)
    odds = _logit(F.col("text_score")) + _logit(_clip(F.col("path_score"))) - math.log(mean / (1 - mean))
    return (
        joined.withColumn("host_score", host_score)
        .withColumn("path_score", path_score)
        .withColumn("score", F.round(F.when(F.col("_words"), 1 / (1 + F.exp(-odds))).otherwise(F.lit(0.0)), 6))
        .select("doc_id", *[F.round(c, 6).alias(c) for c in ("text_score", "host_score", "path_score")], "score", (F.col("score") >= keep).alias("kept"))
    )


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))


def url_path(url: Column) -> Column:
    """The first segment of the path."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)
