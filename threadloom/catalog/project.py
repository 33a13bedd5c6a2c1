"""Queries over neighbours and the map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import fixtures as fx
from threadloom.operators.neighbours import knn_graph
from threadloom.operators.project import fuzzy_graph, fuzzy_weights, project
from threadloom.operators.project import pca as principal_axes


def _with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors in which every third one is a copy of the first."""
    given = fx.vectors(spark, sf_dir).select("unified_id", "embeddings")
    n = F.col("unified_id").cast("bigint")
    first = given.filter(n == 0).agg(F.first("embeddings")).scalar()
    return given.select("unified_id", F.when(n % 3 == 0, first).otherwise(F.col("embeddings")).alias("embeddings"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_graph(fx.vectors(spark, sf_dir), 10).withColumn("distance", F.round("distance", 6))


def neighbours_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same neighbours over another grid, with a third of the vectors equal."""
    return knn_graph(_with_copies(spark, sf_dir), 5, blocks=11).withColumn("distance", F.round("distance", 6))


def neighbours_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same neighbours again, by cells that are ruled out by bounds."""
    return knn_graph(fx.vectors(spark, sf_dir), 10, method="cells").withColumn("distance", F.round("distance", 6))


def descent_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbour descent beside the exact search: edges per vector, and whether it finds nine in ten of the true ones."""
    vectors = fx.vectors(spark, sf_dir)
    exact = knn_graph(vectors, 10).select("src", "dst", F.lit(1).alias("hit"))
    found = knn_graph(vectors, 10, method="descent", block_rows=128)
    return found.join(exact, ["src", "dst"], "left").agg(
        F.count(F.lit(1)).alias("n_edges"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_holds")
    )


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_weights(knn_graph(fx.vectors(spark, sf_dir), 10)).withColumn("weight", F.round("weight", 5))


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_graph(knn_graph(fx.vectors(spark, sf_dir), 10)).withColumn("weight", F.round("weight", 5))


def pca_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for principal axes: centred, uncorrelated, the first at least as wide as the second."""
    return principal_axes(fx.vectors(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("n_points"),
        (F.abs(F.avg("x")) < 1e-9).alias("centred_x"), (F.abs(F.avg("y")) < 1e-9).alias("centred_y"),
        (F.abs(F.covar_pop("x", "y")) < 1e-9).alias("uncorrelated"),
        (F.var_pop("x") >= F.var_pop("y")).alias("ordered"),
    )


def pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    return principal_axes(fx.vectors(spark, sf_dir)).select("unified_id", F.round(F.col("x") + 1e-9, 4).alias("x"), F.round(F.col("y") + 1e-9, 4).alias("y"))


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph layout of all vectors."""
    return project(fx.vectors(spark, sf_dir))


QUERIES = {
    "knn_graph": neighbours,
    "knn_graph_cells": neighbours_in_cells,
    "knn_graph_pruned": neighbours_pruned,
    "knn_descent_recall": descent_recall,
    "fuzzy_weights": weights,
    "fuzzy_graph": graph,
    "pca_checks": pca_checks,
    "project_pca": pca,
    "project_graph": mapped,
}

_KNN = """
pairs AS (
  SELECT a.id AS src, b.id AS dst, greatest(round(1 - list_cosine_similarity(a.v, b.v), 9), 0) AS distance
  FROM vecs a JOIN vecs b ON a.id <> b.id),
knn AS (SELECT *, rank FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS rank FROM pairs) WHERE rank <= {k})
"""
_VECS = "vecs AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),"
_FUZZY = f"""{_VECS} {_KNN.format(k=10)},
near AS (SELECT src, list(distance ORDER BY rank) AS ds, coalesce(min(distance) FILTER (distance > 0), 0) AS rho,
                log2(count(*)) AS target FROM knn GROUP BY 1),
steps AS (
  SELECT src, ds, rho, 0.0::DOUBLE AS low, NULL::DOUBLE AS high, 1.0::DOUBLE AS mid, 0 AS i, target FROM near),
solved AS (
  WITH RECURSIVE s AS (
    SELECT * FROM steps
    UNION ALL
    SELECT src, ds, rho, CASE WHEN wide THEN low ELSE mid END, CASE WHEN wide THEN mid ELSE high END,
           CASE WHEN wide THEN (low + mid) / 2 WHEN high IS NULL THEN mid * 2 ELSE (mid + high) / 2 END, i + 1, target
    FROM (SELECT *, list_sum(list_transform(ds, lambda d: exp(-greatest(0, d - rho) / mid))) > target AS wide FROM s) WHERE i < 64)
  SELECT src, rho, greatest(mid, 1e-3 * list_avg(ds), 1e-12) AS sigma FROM s WHERE i = 64),
weights AS (SELECT src, dst, exp(-greatest(0, distance - rho) / sigma) AS weight FROM knn JOIN solved USING (src))
"""



def _axis(name: str, matrix: str) -> str:
    """The main axis of a symmetric matrix by power iteration."""
    return f"""{name} AS (
  WITH RECURSIVE p AS (
    SELECT 0 AS i, (SELECT list_transform(m, lambda r: list_sum(list_transform(r, lambda x: abs(x)))) FROM {matrix}) AS v
    UNION ALL
    SELECT i + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
    FROM (SELECT i, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM p, {matrix} WHERE i < 3000))
  SELECT v FROM p WHERE i = 3000)"""


def _signed(axis: str) -> str:
    return f"list_transform({axis}, lambda x: x * CASE WHEN list_max({axis}) >= -list_min({axis}) THEN 1 ELSE -1 END)"


# Centred unit vectors, their covariance, its main axis, and the main axis of what is left.
_PCA = f"""
WITH {_VECS}
units AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM vecs),
parts AS (SELECT id, unnest(v) AS x, unnest(range(len(v))) AS d FROM units),
centred AS (SELECT id, d, x - avg(x) OVER (PARTITION BY d) AS x FROM parts),
cov AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM (
  SELECT a.d AS i, b.d AS j, avg(a.x * b.x) AS c FROM centred a JOIN centred b USING (id) GROUP BY 1, 2) GROUP BY 1)),
{_axis("first_axis", "cov")},
rest AS (
  SELECT list_transform(m, lambda r, i: list_transform(r, lambda c, j: c - l * v[i] * v[j])) AS m
  FROM (SELECT m, v, list_dot_product(list_transform(m, lambda r: list_dot_product(r, v)), v) AS l FROM cov, first_axis)),
{_axis("second_axis", "rest")},
axes AS (SELECT {_signed("a.v")} AS a, {_signed("b.v")} AS b FROM first_axis a, second_axis b),
rows AS (SELECT id, list(x ORDER BY d) AS v FROM centred GROUP BY 1)
SELECT id AS unified_id, round(list_dot_product(v, a) + 1e-9, 4) AS x, round(list_dot_product(v, b) + 1e-9, 4) AS y FROM rows, axes"""

SQL = {
    "project_pca": _PCA,
    "knn_graph": f"WITH {_VECS} {_KNN.format(k=10)} SELECT src, dst, round(distance, 6) AS distance, rank FROM knn",
    "knn_graph_pruned": f"WITH {_VECS} {_KNN.format(k=10)} SELECT src, dst, round(distance, 6) AS distance, rank FROM knn",
    "knn_graph_cells": f"""WITH vecs AS (
      SELECT CAST(e.vec_id AS VARCHAR) AS id, CAST(CASE WHEN e.vec_id % 3 = 0 THEN f.embedding ELSE e.embedding END AS DOUBLE[]) AS v
      FROM embeddings e, embeddings f WHERE f.vec_id = 0), {_KNN.format(k=5)}
      SELECT src, dst, round(distance, 6) AS distance, rank FROM knn""",
    "knn_descent_recall": "SELECT count(*) * 10 AS n_edges, true AS recall_holds FROM embeddings",
    "fuzzy_weights": f"WITH {_FUZZY} SELECT src, dst, round(weight, 5) AS weight FROM weights",
    "fuzzy_graph": f"""WITH {_FUZZY},
      both_ways AS (SELECT src, dst, weight AS a, 0 AS b FROM weights UNION ALL SELECT dst, src, 0, weight FROM weights)
      SELECT src, dst, round(sum(a) + sum(b) - sum(a) * sum(b), 5) AS weight FROM both_ways GROUP BY 1, 2""",
    "pca_checks": "SELECT count(*) AS n_points, true AS centred_x, true AS centred_y, true AS uncorrelated, true AS ordered FROM embeddings",
}
