"""Queries over enrichment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import fixtures as fx
from threadloom.functions.vectors import norm
from threadloom.operators import enrich as en
from threadloom.plans.enrichment import enrich
from threadloom.session import run_dir

AS_OF = dt.datetime(2024, 3, 1)
LEXICON = [
    ("the", 0.5), ("and", -0.25), ("of", 1.0), ("on", -1.0), ("que", 0.75), ("les", -0.5), ("der", 0.25), ("und", -0.75),
    ("le", 0.25), ("worthless", -1.0),
]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "term string, weight double")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.document_items(spark, sf_dir).select("content_item_id", F.col("primary_text").alias("content"))


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as the cache: every seventh one empty, sentiment known where a label is."""
    labels = fx.table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("unified_id"),
        ((F.col("quality") - F.col("toxic")) / 2).alias("sentiment_score"),
        (F.col("quality") + F.col("toxic")).cast("double").alias("sentiment_magnitude"),
    )
    vectors = fx.vectors(spark, sf_dir).withColumn(
        "embeddings",
        F.when(F.col("unified_id").cast("bigint") % 7 == 0, F.array().cast("array<double>")).otherwise(F.col("embeddings")),
    )
    return vectors.join(labels, "unified_id", "left").select(
        "unified_id", "embeddings", F.lit("given").alias("embedding_model_name"),
        F.lit(en.EMBEDDING_TASK).alias("embedding_task_type"), F.lit(AS_OF).cast("timestamp").alias("embedding_generated_at"),
        "sentiment_score", "sentiment_magnitude", "label",
    )


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = en.pending_items(fx.document_items(spark, sf_dir), cache(spark, sf_dir), AS_OF)
    return found.select("content_item_id", F.md5("content").alias("content_md5"))


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending items without a lookback."""
    found = en.pending_items(fx.document_items(spark, sf_dir), cache(spark, sf_dir), AS_OF, lookback=None)
    return found.select("content_item_id")


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = docs(spark, sf_dir)
    result = en.embed_text(given, en.fit_embedder(given))
    return result.select(
        "content_item_id", "embedding_status", F.size("embeddings").cast("bigint").alias("dims"),
        F.round(norm(F.col("embeddings")), 6).alias("length"),
    )


def _rounded(col: str):
    """Six places, moved off exact halves: the order of a sum may change its last bit and so how a half rounds."""
    return F.round(F.col(col) + 1e-9, 6)


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = en.score_sentiment(docs(spark, sf_dir), lexicon(spark))
    return scored.withColumns({c: _rounded(c) for c in ("sentiment_score", "sentiment_magnitude")})


def parsed_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    score = F.when(doc % 5 == 0, F.lit('"none"')).otherwise((F.col("quality") - F.col("toxic")).cast("string"))
    text = F.concat(
        F.lit('{"document_sentiment": {"score": '), score, F.lit(', "magnitude": '), F.col("quality").cast("string"), F.lit(".5}}")
    )
    results = fx.table(spark, sf_dir, "labels").select(
        doc.cast("string").alias("content_item_id"), F.when(doc % 7 == 0, F.lit("{")).otherwise(text).alias("result"),
        F.when(doc % 7 == 0, "INTERNAL").otherwise("").alias("status"),
    )
    return en.parse_sentiment(results)


def sentiment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = docs(spark, sf_dir).join(
        fx.table(spark, sf_dir, "labels").select(
            F.col("doc_id").cast("string").alias("content_item_id"), ((F.col("quality") - F.col("toxic")) * 0.25).alias("score")
        ),
        "content_item_id", "left",
    )
    return scored.groupBy(en.sentiment_label(F.col("score")).alias("sentiment_label")).agg(F.count(F.lit(1)).alias("n_items"))


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("content_item_id").cast("bigint")
    base = docs(spark, sf_dir).select("content_item_id")
    left = base.filter((doc % 3 != 0) | (doc % 5 == 0)).select(
        "content_item_id", F.array(doc.cast("double")).alias("embeddings"), F.lit("given_model").alias("embedding_model_name"),
        F.when(doc % 4 == 0, "QUOTA").when(doc % 4 == 1, "").alias("embedding_status"),
    )
    right = base.filter(doc % 5 != 0).select(
        "content_item_id", (doc % 3 - 1).cast("double").alias("sentiment_score"), F.lit(1.0).alias("sentiment_magnitude"),
        F.when(doc % 11 == 0, "LANGUAGE").otherwise("").alias("sentiment_status"),
    )
    rows = en.combine_enrichment(left, right, AS_OF)
    return rows.withColumns(
        {"embeddings": F.element_at("embeddings", 1), "embedding_generated_at": fx.text_time("embedding_generated_at")}
    )


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return en.keywords(docs(spark, sf_dir)).withColumn("keyword_list", F.array_join("keyword_list", " "))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return en.collocations(docs(spark, sf_dir))


def phrase_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of which some are phrases."""
    given = docs(spark, sf_dir)
    return en.keywords(given, phrases=en.collocations(given)).withColumn("keyword_list", F.array_join("keyword_list", ","))


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents, rated by their quality."""
    labels = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("content_item_id"), (2 * F.col("quality") - 1).alias("score"))
    return docs(spark, sf_dir).join(labels, "content_item_id")


def learned_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of words that tell good documents from bad ones."""
    return en.learn_lexicon(rated(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


def enriched_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job run twice over the documents: the cache holds each recent one once, as first written."""
    root = run_dir(spark, "enrich")
    items = fx.document_items(spark, sf_dir)
    words_of = lexicon(spark)
    for as_of in (AS_OF, AS_OF + dt.timedelta(hours=1)):
        model = en.kept_embedder(docs(spark, sf_dir), f"{root}_embedder")
        table = enrich(
            items, root, as_of, lambda d: en.embed_text(d, model), lambda d: en.score_sentiment(d, words_of),
            lookback=as_of - AS_OF + en.LOOKBACK,
        )
    return table.select(
        "unified_id", F.regexp_extract("embedding_model_name", "^(hashed_tfidf_256)_[0-9a-f]{8}$", 1).alias("embedding_model_name"),
        "embedding_task_type", fx.text_time("embedding_generated_at"), F.size("embeddings").cast("bigint").alias("dims"), _rounded("sentiment_score").alias("sentiment_score"),
        _rounded("sentiment_magnitude").alias("sentiment_magnitude"),
    )


QUERIES = {
    "pending_items": pending,
    "pending_backfill": backfill,
    "embed_text": embedded,
    "score_sentiment": sentiment,
    "parse_sentiment": parsed_sentiment,
    "sentiment_label": sentiment_labels,
    "combine_enrichment": combined,
    "keywords": keywords,
    "collocations": phrases,
    "phrase_keywords": phrase_keywords,
    "learn_lexicon": learned_lexicon,
    "enrich": enriched_twice,
}

_LEXICON_SQL = ", ".join(f"('{term}', {weight})" for term, weight in LEXICON)
SENTIMENT = f"""
lexicon(term, weight) AS (VALUES {_LEXICON_SQL}),
sent AS (SELECT doc_id, unnest(range(len(parts))) AS i, unnest(parts) AS part
         FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?\\n]+') AS parts FROM documents)),
tok AS (SELECT doc_id, i, unnest(regexp_split_to_array(lower(part), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM sent),
means AS (SELECT doc_id, i, CAST(coalesce(sum(weight), 0) AS DOUBLE) / count(*) AS m
          FROM tok LEFT JOIN lexicon USING (term) WHERE term <> '' GROUP BY 1, 2),
scores AS (SELECT doc_id, CASE WHEN avg(m) > 1 THEN 1.0 WHEN avg(m) < -1 THEN -1.0 ELSE avg(m) END AS score, sum(abs(m)) AS magnitude FROM means GROUP BY 1)
"""
CACHE = """
cache AS (
  SELECT CAST(vec_id AS VARCHAR) AS unified_id, vec_id, vec_id % 7 = 0 AS no_vector, embedding, label,
         (quality - toxic) / 2 AS sentiment_score, CAST(quality + toxic AS DOUBLE) AS sentiment_magnitude
  FROM embeddings LEFT JOIN labels ON vec_id = doc_id)
"""
_PENDING = f"""WITH {CACHE}
SELECT CAST(d.doc_id AS VARCHAR) AS content_item_id, md5(d.text) AS content_md5
FROM documents d LEFT JOIN cache c ON c.vec_id = d.doc_id
WHERE (c.vec_id IS NULL OR c.no_vector OR c.sentiment_score IS NULL) AND length(trim(d.text, e' \\t\\n\\r')) > 0"""

# Words in order, counts of words and of neighbouring ones, and the pairs that are phrases.
PHRASES = r"""said AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
ones AS (SELECT term, count(*) AS c FROM (SELECT unnest(w) AS term FROM said) GROUP BY 1),
pairs AS (SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS term FROM said),
twos AS (SELECT term, count(*) AS n FROM pairs GROUP BY 1 HAVING n >= 5),
npmi AS (SELECT t.term, n, round((ln(n) + ln(total) - ln(a.c) - ln(b.c)) / (ln(total) - ln(n)), 6) AS npmi
         FROM twos t JOIN ones a ON a.term = split_part(t.term, ' ', 1) JOIN ones b ON b.term = split_part(t.term, ' ', 2), (SELECT sum(c) AS total FROM ones)),
phrases AS (SELECT * FROM npmi WHERE npmi >= 0.5)
"""

SQL = {
    "collocations": f"WITH {PHRASES} SELECT term, n, npmi FROM phrases",
    "phrase_keywords": f"""WITH {PHRASES},
      tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM said) GROUP BY 1, 2
             UNION ALL SELECT doc_id, term, count(*) FROM pairs WHERE term IN (SELECT term FROM phrases) GROUP BY 1, 2),
      df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
      w AS (SELECT doc_id, term, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS weight FROM tf JOIN df USING (term)),
      r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS rank FROM w)
      SELECT CAST(doc_id AS VARCHAR) AS content_item_id, string_agg(term, ',' ORDER BY rank) AS keyword_list
      FROM r WHERE rank <= 5 GROUP BY 1""",
    "learn_lexicon": r"""WITH spoken AS (
        SELECT quality, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term FROM documents JOIN labels USING (doc_id)),
      counts AS (SELECT term, count(*) FILTER (quality > 0) AS p, count(*) FILTER (quality <= 0) AS q FROM spoken WHERE term <> '' GROUP BY 1),
      totals AS (SELECT sum(p)::DOUBLE AS p, sum(q)::DOUBLE AS q FROM counts),
      mixed AS (SELECT term, c.p AS n_positive, c.q AS n_negative, t.p AS tp, t.q AS tq,
        c.p + 500.0::DOUBLE * (c.p + c.q) / (t.p + t.q) AS sp, c.q + 500.0::DOUBLE * (c.p + c.q) / (t.p + t.q) AS sq FROM counts c, totals t),
      scored AS (SELECT *, (ln(sp / (tp + 500 - sp)) - ln(sq / (tq + 500 - sq))) / sqrt(1 / sp + 1 / sq) AS z FROM mixed)
      SELECT term, n_positive, n_negative, round(z / (1 + abs(z)), 6) AS weight FROM scored WHERE abs(z) >= 1.96""",
    "pending_items": _PENDING + " AND d.doc_id % 5 <= 2",
    "pending_backfill": f"SELECT content_item_id FROM ({_PENDING})",
    "embed_text": f"""WITH {SENTIMENT}
    SELECT CAST(doc_id AS VARCHAR) AS content_item_id, CASE WHEN s.doc_id IS NULL THEN 'empty' ELSE '' END AS embedding_status,
           CASE WHEN s.doc_id IS NOT NULL THEN 256 END AS dims, CAST(CASE WHEN s.doc_id IS NOT NULL THEN 1 END AS DOUBLE) AS length
    FROM documents d LEFT JOIN scores s USING (doc_id)""",
    "score_sentiment": f"""WITH {SENTIMENT}
    SELECT CAST(doc_id AS VARCHAR) AS content_item_id, round(score + 1e-9, 6) AS sentiment_score, round(magnitude + 1e-9, 6) AS sentiment_magnitude,
           CASE WHEN score IS NULL THEN 'empty' ELSE '' END AS sentiment_status
    FROM documents LEFT JOIN scores USING (doc_id)""",
    "parse_sentiment": """SELECT CAST(doc_id AS VARCHAR) AS content_item_id,
      CAST(CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 <> 0 THEN quality - toxic END AS DOUBLE) AS sentiment_score,
      CAST(CASE WHEN doc_id % 7 <> 0 THEN quality + 0.5 END AS DOUBLE) AS sentiment_magnitude,
      CASE WHEN doc_id % 7 = 0 THEN 'INTERNAL' ELSE '' END AS sentiment_status FROM labels""",
    "sentiment_label": """SELECT CASE WHEN quality IS NULL THEN 'Error' WHEN quality > toxic THEN 'Positive'
      WHEN quality < toxic THEN 'Negative' ELSE 'Neutral' END AS sentiment_label, count(*) AS n_items
      FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "combine_enrichment": """WITH e AS (SELECT doc_id AS a, CASE doc_id % 4 WHEN 0 THEN 'QUOTA' WHEN 1 THEN '' END AS es FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 5 = 0),
      s AS (SELECT doc_id AS b, CASE WHEN doc_id % 11 = 0 THEN 'LANGUAGE' ELSE '' END AS ss FROM documents WHERE doc_id % 5 <> 0)
      SELECT CAST(coalesce(a, b) AS VARCHAR) AS unified_id, CAST(a AS DOUBLE) AS embeddings,
             CASE WHEN a IS NOT NULL THEN 'given_model' END AS embedding_model_name, 'CLUSTERING' AS embedding_task_type,
             '2024-03-01 00:00:00' AS embedding_generated_at, CAST(b % 3 - 1 AS DOUBLE) AS sentiment_score,
             CASE WHEN b IS NOT NULL THEN 1.0 END::DOUBLE AS sentiment_magnitude
      FROM e FULL JOIN s ON a = b WHERE coalesce(es, '') = '' AND coalesce(ss, '') = ''""",
    "keywords": """WITH tok AS (
        SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM documents),
      tf AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE term <> '' GROUP BY 1, 2),
      df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
      w AS (SELECT doc_id, term, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS weight FROM tf JOIN df USING (term)),
      r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS rank FROM w)
      SELECT CAST(doc_id AS VARCHAR) AS content_item_id, string_agg(term, ' ' ORDER BY rank) AS keyword_list
      FROM r WHERE rank <= 5 GROUP BY 1""",
    "enrich": f"""WITH {SENTIMENT}
    SELECT CAST(doc_id AS VARCHAR) AS unified_id, 'hashed_tfidf_256' AS embedding_model_name, 'CLUSTERING' AS embedding_task_type,
           '2024-03-01 00:00:00' AS embedding_generated_at, 256 AS dims,
           round(score + 1e-9, 6) AS sentiment_score, round(magnitude + 1e-9, 6) AS sentiment_magnitude
    FROM scores WHERE doc_id % 5 <= 2""",
}
