"""Queries over topics and marts."""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import fixtures as fx
from threadloom.catalog.enrich import AS_OF, CACHE, cache
from threadloom.functions.vectors import dot, unit
from threadloom.operators import enrich as en
from threadloom.operators import marts, topics
from threadloom.session import cut, run_dir
from threadloom.streaming.trend import read_trend, trend_stream

RUN = "run_labels"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.vectors_for(cache(spark, sf_dir))


def _given_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean vector of each given label, so that assignment has an exact answer."""
    return topics.mean_centers(_vectors(spark, sf_dir), F.col("label") + 1)


def _assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.item_vectors(fx.document_items(spark, sf_dir), cache(spark, sf_dir))
    return topics.topic_assignments(topics.assign_topics(rows, _given_centers(spark, sf_dir)), RUN, AS_OF)


def selected_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable vectors of the ids a user pasted: every second document."""
    ids = fx.document_items(spark, sf_dir).filter(F.col("content_item_id").cast("bigint") % 2 == 0).select(
        F.col("content_item_id").alias("unified_id")
    )
    found = topics.vectors_for(cache(spark, sf_dir), ids)
    return found.select("unified_id", F.size("embeddings").cast("bigint").alias("dims"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = fx.document_items(spark, sf_dir).select(F.col("content_item_id").alias("unified_id"))
    return topics.coverage(cache(spark, sf_dir), ids)


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.item_vectors(fx.document_items(spark, sf_dir), cache(spark, sf_dir))
    return rows.select("unified_id", "source", "content_type", fx.text_time("content_timestamp"), F.md5("primary_text").alias("text_md5"), "sentiment_score")


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = topics.centroid_distances(_vectors(spark, sf_dir), _given_centers(spark, sf_dir))
    return every.select("unified_id", F.posexplode("nearest_centroids").alias("pos", "c")).select(
        "unified_id", F.col("c.topic_id").alias("topic_id"), F.round("c.distance", 6).alias("distance")
    )


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _assignments(spark, sf_dir)
    return rows.withColumns(
        {
            "assigned_at": fx.text_time("assigned_at"), "content_timestamp": fx.text_time("content_timestamp"),
            "assignment_score": F.round("assignment_score", 6), "primary_text": F.md5("primary_text"),
        }
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.predictions(_assignments(spark, sf_dir))
    return rows.withColumns({"created_at": fx.text_time("created_at"), "distance": F.round("distance", 6)})


def top_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = topics.top_documents(_assignments(spark, sf_dir), RUN)
    return top.withColumn("avg_assignment_score", F.round("avg_assignment_score", 6))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = topics.topic_prompts(topics.top_documents(_assignments(spark, sf_dir), RUN), "Documents:\n{documents}\nLABEL:")
    return made.select("topic_id", "prompt")


def fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted model, saved and loaded, checked against what must hold: every vector in its nearest topic."""
    vectors = _vectors(spark, sf_dir)
    path = run_dir(spark, "model")
    topics.fit_topics(vectors, 5, seed=7).write().overwrite().save(path)
    model = KMeansModel.load(path)
    centers = topics.centers_of(spark, model)
    assigned = topics.assign_topics(vectors, centers)
    predicted = model.transform(
        vectors.select("unified_id", topics.array_to_vector("embeddings").alias("features"))
    ).select("unified_id", (F.col("prediction") + 1).alias("predicted"))
    both = assigned.join(predicted, "unified_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.count_if(F.col("topic_id") == F.col("predicted")).alias("n_agree"),
        F.countDistinct("topic_id").alias("n_topics"),
        F.count_if(F.col("assignment_score").between(-1e-9, 2)).alias("n_in_range"),
    )


def fitted_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fit must have reached: five topics that hold all vectors, each centre pointing where its members' mean does."""
    vectors = _vectors(spark, sf_dir)
    centers = topics.centers_of(spark, topics.fit_topics(vectors, 5, seed=7))
    assigned = topics.assign_topics(vectors, centers)
    means = topics.mean_centers(assigned.withColumn("embeddings", unit(F.col("embeddings"))), F.col("topic_id")).withColumnRenamed("center", "mean")
    cosine = dot(unit(F.col("center")), unit(F.col("mean")))
    sizes = assigned.groupBy("topic_id").agg(F.count(F.lit(1)).alias("n"))
    return centers.join(means, "topic_id").join(sizes, "topic_id").agg(
        F.sum("n").alias("n_vectors"), F.count(F.lit(1)).alias("n_topics"), (F.min(cosine) > 0.9999).alias("centres_are_means")
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = topics.label_topics(_assignments(spark, sf_dir), RUN, AS_OF)
    return made.select(
        "run_id", "topic_id", fx.text_time("created_at"), "topic_label", F.round("confidence_score", 6).alias("confidence_score"),
        "num_documents_used", F.round("avg_assignment_score", 6).alias("avg_assignment_score"), "topic_description", "model_metadata",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model response per document, in the ways responses turn out."""
    doc = F.col("doc_id")

    def answer(label: str, description: str, confidence: str):
        text = F.concat(
            F.lit("  Here:\\nLABEL: " + label + "\\nDESCRIPTION: " + description + " "), doc, F.lit("\\nCONFIDENCE: " + confidence + " \\nLABEL: other\\n")
        )
        return F.concat(
            F.lit('{"candidates": [{"content": {"parts": [{"text": "'), text,
            F.lit('"}]}, "score": 0.5, "finish_reason": "STOP"}], "model_version": "m1", "usage_metadata": {"total": 7}}'),
        )

    kinds = [
        answer("Good LABEL:name", "It is. Fine.", "0.85"), answer("", "It is.", "0.5"), answer("w " * 16, "It is.", "0.5"),
        answer("Good", "a.b.c.d.e.f.g.h", "0.5"), answer("Good", "It is.", "1.5"), answer("Good", "It is.", "high"),
        F.lit('{"candidates": []}'), F.lit('{"candidates": [{"content": {"parts": []}}]}'), F.concat(F.lit("not json "), doc),
        F.concat(F.lit('{"candidates": [{"content": {"parts": [{"text": "LABEL: x'), doc, F.lit('"}]}}]}')),
    ]
    response = F.when(doc % 10 == 0, kinds[0])
    for i, kind in enumerate(kinds[1:], 1):
        response = response.when(doc % 10 == i, kind)
    given = fx.table(spark, sf_dir, "documents").select(
        doc.alias("topic_id"), response.alias("response"), F.concat(F.lit("prompt "), doc).alias("prompt"),
        F.lit(10).cast("bigint").alias("num_documents"), F.lit(0.25).alias("avg_assignment_score"),
    )
    rows = topics.parse_label_responses(given, RUN, AS_OF)
    return rows.withColumn("created_at", fx.text_time("created_at"))


def _label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.label_topics(_assignments(spark, sf_dir), RUN, AS_OF)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fx.document_items(spark, sf_dir)
    lists = en.keywords(items.select("content_item_id", F.col("primary_text").alias("content")), k=3)
    # The labels and the mart both read the assignments, so they are written once, as a run does.
    assigned = cut(_assignments(spark, sf_dir))
    labels = topics.label_topics(assigned, RUN, AS_OF)
    wide = marts.enriched_items(items, cache(spark, sf_dir), AS_OF, lists, assigned, labels, RUN)
    return wide.select(
        "run_id", "processing_type", "source", "content_type", "content_item_id", "top_level_post_id",
        fx.text_time("analysis_timestamp"), F.md5("text_analyzed_for_nlp").alias("text_md5"), "sentiment_label", "sentiment_score",
        "topic_id", "topic_label", F.array_join("keyword_list", " ").alias("keyword_list"),
    )


def enriched_general(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = marts.enriched_items(fx.document_items(spark, sf_dir), cache(spark, sf_dir), AS_OF, text_col="primary_text")
    return wide.groupBy("processing_type", "sentiment_label").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum(F.length("text_analyzed_for_nlp")).alias("chars"), F.count("run_id").alias("n_runs")
    )


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marts.topic_summary(_assignments(spark, sf_dir), _label_rows(spark, sf_dir))
    numbers = ("avg_assignment_score", "avg_sentiment_score", "avg_sentiment_magnitude")
    return rows.withColumns({c: F.round(c, 6) for c in numbers}).drop("topic_description", "confidence_score")


def trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marts.sentiment_trend(_assignments(spark, sf_dir))
    return rows.withColumns({"day": F.col("day").cast("string"), "avg_sentiment_score": F.round("avg_sentiment_score", 6)})


def trend_of_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend kept by a stream: the assignments come in the order they were said, in eight files, a tenth of them one file late.

    Days are forgotten when two files and a day have passed.
    """
    root = run_dir(spark, "trend")
    rows = cut(_assignments(spark, sf_dir))
    said = F.unix_timestamp("content_timestamp")
    first, last = rows.agg(F.coalesce(F.min(said), F.lit(0)), F.coalesce(F.max(said), F.lit(0))).first()
    late = (F.crc32(F.col("unified_id").cast("binary")) % 10 == 0).cast("int")
    slot = F.least(F.floor(8 * (said - first) / (last - first + 1)) + late, F.lit(7))
    for number in range(8):
        rows.filter(slot == number).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    trend_stream(stream, f"{root}/trend", f"{root}/checkpoint", f"{(last - first) // 4 + 86_400} seconds").awaitTermination()
    out = read_trend(spark, f"{root}/trend")
    return out.withColumns({"day": F.col("day").cast("string"), "avg_sentiment_score": F.round("avg_sentiment_score", 6)})


def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two vector components as coordinates, joined to topic and label."""
    coordinates = _vectors(spark, sf_dir).select(
        F.lit(RUN).alias("run_id"), "unified_id", F.element_at("embeddings", 1).alias("umap_x"), F.element_at("embeddings", 2).alias("umap_y")
    )
    placed = marts.map_view(coordinates, _assignments(spark, sf_dir), _label_rows(spark, sf_dir))
    return placed.select("run_id", "unified_id", F.round("umap_x", 6).alias("umap_x"), F.round("umap_y", 6).alias("umap_y"), "topic_id", "topic_label")


QUERIES = {
    "vectors_for": selected_vectors,
    "vector_coverage": coverage,
    "item_vectors": item_vectors,
    "centroid_distances": distances,
    "topic_assignments": assignments,
    "topic_predictions": predictions,
    "top_documents": top_documents,
    "topic_prompts": prompts,
    "fit_topics": fitted,
    "fitted_topic_sizes": fitted_topics,
    "label_topics": labels,
    "parse_label_responses": responses,
    "enriched_items": enriched,
    "enriched_general": enriched_general,
    "topic_summary": summary,
    "sentiment_trend": trend,
    "sentiment_trend_stream": trend_of_stream,
    "map_view": map_points,
}

ASSIGNED = CACHE + f""",
usable AS (SELECT *, CAST(embedding AS DOUBLE[]) AS v FROM cache WHERE NOT no_vector),
parts AS (SELECT label, unnest(v) AS x, unnest(range(len(v))) AS pos FROM usable),
centers AS (SELECT label + 1 AS topic_id, list(m ORDER BY pos) AS center
            FROM (SELECT label, pos, avg(x) AS m FROM parts GROUP BY 1, 2) GROUP BY 1),
distances AS (SELECT unified_id, vec_id, topic_id, 1 - list_cosine_similarity(v, center) AS distance FROM usable, centers),
assigned AS (
  SELECT '{RUN}' AS run_id, n.unified_id, CAST(n.topic_id AS BIGINT) AS topic_id, n.distance AS assignment_score, d.source,
         d.text AS primary_text, TIMESTAMP '2024-01-01' + to_hours(CAST(d.doc_id % 10000 AS INTEGER)) AS said,
         u.sentiment_score, u.sentiment_magnitude, d.doc_id
  FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, topic_id) AS r FROM distances) n
  JOIN documents d ON d.doc_id = n.vec_id JOIN usable u ON u.vec_id = n.vec_id WHERE r = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY assignment_score, unified_id) AS doc_rank FROM assigned),
tops AS (
  SELECT topic_id, string_agg(substr(primary_text, 1, 500), e'\\n---\\n' ORDER BY doc_rank) AS topic_documents,
         avg(assignment_score) AS avg_assignment_score, count(*) AS num_documents
  FROM ranked WHERE doc_rank <= 10 GROUP BY 1)
"""
LABELLED = ASSIGNED + f""",
toks AS (SELECT topic_id, doc_id, unnest(regexp_split_to_array(lower(primary_text), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM assigned),
tf AS (SELECT topic_id, term, count(*) AS tf FROM toks WHERE term <> '' GROUP BY 1, 2),
weights AS (SELECT topic_id, term, round(tf * ln(1 + (SELECT sum(tf) / count(DISTINCT topic_id) FROM tf) / f), 6) AS weight
            FROM tf JOIN (SELECT term, sum(tf) AS f FROM tf GROUP BY 1) USING (term)),
terms AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, term) AS rank FROM weights) WHERE rank <= 5),
names AS (SELECT topic_id, string_agg(term, ' ' ORDER BY rank) AS topic_label, string_agg(term, ', ' ORDER BY rank) AS listed FROM terms GROUP BY 1),
hits AS (SELECT topic_id, count(DISTINCT doc_id) AS n FROM toks JOIN terms USING (topic_id, term) GROUP BY 1),
sizes AS (SELECT topic_id, count(*) AS n_docs FROM assigned GROUP BY 1),
labelled AS (
  SELECT '{RUN}' AS run_id, topic_id, '2024-03-01 00:00:00' AS created_at, topic_label,
         round(CAST(hits.n AS DOUBLE) / n_docs, 6) AS confidence_score, num_documents AS num_documents_used,
         round(avg_assignment_score, 6) AS avg_assignment_score, 'Most typical words: ' || listed || '.' AS topic_description,
         '{{"model_version":"class_tfidf","n_docs":' || n_docs || '}}' AS model_metadata
  FROM tops JOIN names USING (topic_id) JOIN hits USING (topic_id) JOIN sizes USING (topic_id))
"""

SQL = {
    "vectors_for": """SELECT CAST(vec_id AS VARCHAR) AS unified_id, len(embedding) AS dims FROM embeddings
      WHERE vec_id % 7 <> 0 AND vec_id % 2 = 0 AND vec_id IN (SELECT doc_id FROM documents)""",
    "vector_coverage": """SELECT count(*) AS requested, count(*) FILTER (vec_id % 7 <> 0) AS found
      FROM documents LEFT JOIN embeddings ON vec_id = doc_id""",
    "item_vectors": f"""WITH {CACHE}
      SELECT unified_id, source, 'post' AS content_type,
             strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 10000 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS content_timestamp,
             md5(text) AS text_md5, sentiment_score FROM cache JOIN documents ON doc_id = vec_id WHERE NOT no_vector""",
    "centroid_distances": f"WITH {ASSIGNED} SELECT unified_id, CAST(topic_id AS BIGINT) AS topic_id, round(distance, 6) AS distance FROM distances",
    "topic_assignments": f"""WITH {ASSIGNED}
      SELECT run_id, '2024-03-01 00:00:00' AS assigned_at, unified_id, source, 'post' AS content_type,
             strftime(said, '%Y-%m-%d %H:%M:%S') AS content_timestamp, md5(primary_text) AS primary_text, topic_id,
             round(assignment_score, 6) AS assignment_score, sentiment_score, sentiment_magnitude FROM assigned""",
    "topic_predictions": f"""WITH {ASSIGNED}
      SELECT run_id, unified_id, topic_id AS predicted_cluster, round(assignment_score, 6) AS distance,
             '2024-03-01 00:00:00' AS created_at FROM assigned""",
    "top_documents": f"""WITH {ASSIGNED}
      SELECT topic_id, topic_documents, round(avg_assignment_score, 6) AS avg_assignment_score, num_documents FROM tops""",
    "topic_prompts": f"WITH {ASSIGNED} SELECT topic_id, e'Documents:\\n' || topic_documents || e'\\nLABEL:' AS prompt FROM tops",
    "fit_topics": f"""WITH {CACHE}
      SELECT count(*) AS n_vectors, count(*) AS n_agree, 5 AS n_topics, count(*) AS n_in_range FROM cache WHERE NOT no_vector""",
    "fitted_topic_sizes": f"WITH {CACHE} SELECT count(*) AS n_vectors, 5 AS n_topics, true AS centres_are_means FROM cache WHERE NOT no_vector",
    "label_topics": f"WITH {LABELLED} SELECT * FROM labelled",
    "parse_label_responses": f"""WITH d AS (SELECT doc_id, doc_id % 10 AS c FROM documents),
      t AS (SELECT doc_id, c, CASE c WHEN 1 THEN '' WHEN 2 THEN repeat('w ', 16) WHEN 9 THEN NULL ELSE 'Good' END AS label,
                   CASE c WHEN 3 THEN 'a.b.c.d.e.f.g.h' ELSE 'It is.' END AS description,
                   CASE c WHEN 4 THEN '1.5' WHEN 5 THEN 'high' ELSE '0.5' END AS confidence FROM d),
      x AS (SELECT *, CASE WHEN c = 8 THEN 'not json ' || doc_id WHEN c = 9 THEN 'LABEL: x' || doc_id
                           ELSE 'Here:' || chr(10) || 'LABEL: ' || label || chr(10) || 'DESCRIPTION: ' || description || ' ' || doc_id || chr(10)
                                || 'CONFIDENCE: ' || confidence || ' ' || chr(10) || 'LABEL: other' END AS raw,
                   CASE c WHEN 1 THEN 'Label cannot be empty' WHEN 2 THEN 'Label is too long (should be concise)'
                          WHEN 3 THEN 'Description must be 1-2 sentences' WHEN 4 THEN 'Confidence must be between 0 and 1'
                          WHEN 5 THEN 'Confidence is not a number: high' WHEN 6 THEN 'No candidates in response'
                          WHEN 7 THEN 'No content parts in candidate' WHEN 8 THEN 'Invalid JSON response' ELSE '' END AS fault FROM t)
      SELECT '{RUN}' AS run_id, doc_id AS topic_id, '2024-03-01 00:00:00' AS created_at,
             CASE WHEN c = 0 THEN 'Good name' WHEN c IN (6, 7, 8) THEN 'Error: ' || fault ELSE 'Error: Invalid response format' END AS topic_label,
             CASE WHEN c = 0 THEN 'It is. Fine. ' || doc_id WHEN c IN (6, 7) THEN NULL ELSE 'Raw response: ' || raw || '...' END AS topic_description,
             CAST(CASE WHEN c = 0 THEN 0.85 ELSE 0 END AS DOUBLE) AS confidence_score, 10 AS num_documents_used,
             CAST(0.25 AS DOUBLE) AS avg_assignment_score,
             CASE WHEN c = 0 THEN '{{"avg_logprobs":0,"score":0.5,"finish_reason":"STOP","model_version":"m1","response_id":null,"prompt_used":"prompt '
                                  || doc_id || '","usage_metadata":{{"total":7}}}}'
                  WHEN c IN (6, 7) THEN '{{"error":"' || fault || '"}}'
                  ELSE '{{"error":"' || fault || '","raw_response":"' || replace(raw, chr(10), '\\n') || '","prompt_used":"prompt ' || doc_id || '"}}'
             END AS model_metadata FROM x""",
    "enriched_items": f"""WITH {LABELLED},
      kw_tf AS (SELECT doc_id, term, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM documents) WHERE term <> '' GROUP BY 1, 2),
      kw_df AS (SELECT term, count(*) AS df FROM kw_tf GROUP BY 1),
      kw_weights AS (SELECT doc_id, term, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS weight FROM kw_tf JOIN kw_df USING (term)),
      kw_placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS rank FROM kw_weights),
      words AS (SELECT doc_id, string_agg(term, ' ' ORDER BY rank) AS terms FROM kw_placed WHERE rank <= 3 GROUP BY 1)
      SELECT '{RUN}' AS run_id, 'ad_hoc_consultant' AS processing_type, d.source, 'post' AS content_type,
             CAST(d.doc_id AS VARCHAR) AS content_item_id, CAST(d.doc_id AS VARCHAR) AS top_level_post_id,
             '2024-03-01 00:00:00' AS analysis_timestamp, md5(d.lang || ' ' || d.text) AS text_md5,
             CASE WHEN c.sentiment_score IS NULL THEN 'Error' WHEN c.sentiment_score >= 0.25 THEN 'Positive'
                  WHEN c.sentiment_score <= -0.25 THEN 'Negative' ELSE 'Neutral' END AS sentiment_label,
             c.sentiment_score, a.topic_id, l.topic_label, coalesce(w.terms, '') AS keyword_list
      FROM documents d LEFT JOIN cache c ON c.vec_id = d.doc_id LEFT JOIN assigned a USING (doc_id)
      LEFT JOIN labelled l ON l.topic_id = a.topic_id LEFT JOIN words w ON w.doc_id = d.doc_id""",
    "enriched_general": f"""WITH {CACHE}
      SELECT 'scheduled_general' AS processing_type,
             CASE WHEN sentiment_score IS NULL THEN 'Error' WHEN sentiment_score >= 0.25 THEN 'Positive'
                  WHEN sentiment_score <= -0.25 THEN 'Negative' ELSE 'Neutral' END AS sentiment_label,
             count(*) AS n_items, CAST(sum(length(text)) AS BIGINT) AS chars, 0 AS n_runs
      FROM documents LEFT JOIN cache ON vec_id = doc_id GROUP BY 2""",
    "topic_summary": f"""WITH {LABELLED}
      SELECT a.run_id, a.topic_id, count(*) AS num_documents, round(avg(a.assignment_score), 6) AS avg_assignment_score,
             round(avg(sentiment_score), 6) AS avg_sentiment_score, round(avg(sentiment_magnitude), 6) AS avg_sentiment_magnitude,
             any_value(l.topic_label) AS topic_label
      FROM assigned a LEFT JOIN labelled l USING (topic_id) GROUP BY 1, 2""",
    "sentiment_trend": f"""WITH {ASSIGNED}
      SELECT run_id, strftime(said, '%Y-%m-%d') AS day, source, topic_id, count(*) AS num_documents,
             round(avg(sentiment_score), 6) AS avg_sentiment_score, sum(sentiment_magnitude) AS sentiment_magnitude
      FROM assigned GROUP BY 1, 2, 3, 4""",
    "map_view": f"""WITH {LABELLED}
      SELECT a.run_id, a.unified_id, round(u.v[1], 6) AS umap_x, round(u.v[2], 6) AS umap_y, a.topic_id, l.topic_label
      FROM assigned a JOIN usable u USING (unified_id) JOIN labelled l ON l.topic_id = a.topic_id""",
}
SQL["sentiment_trend_stream"] = SQL["sentiment_trend"]
