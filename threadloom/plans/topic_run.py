"""One topic run: fit, assign, project, pick top documents, label."""

from __future__ import annotations

import datetime as dt
import hashlib
import itertools
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators import runs, topics
from threadloom.operators.enrich import keywords
from threadloom.operators.marts import enriched_items
from threadloom.operators.project import project
from threadloom.operators.quality import QualityError, require_unique
from threadloom.operators.sinks import write_declared
from threadloom.session import cut, discard

# A labeller takes (topic_id, prompt) and returns (topic_id, response).
Labeller = Callable[[DataFrame], DataFrame]


@dataclass
class RunResult:
    run_id: str
    requested: int = 0
    found: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def new_run_id(ids: DataFrame, k: int, as_of: dt.datetime) -> str:
    """Second, topic count and a digest of the ids, so runs of one second do not collide."""
    # Distinct ids, or an id given twice would cancel itself out.
    digest = ids.select("unified_id").distinct().agg(F.coalesce(F.bit_xor(F.xxhash64("unified_id")), F.lit(0)).alias("d")).first()["d"]
    mark = hashlib.md5(f"{digest}:{k}".encode()).hexdigest()[:8]
    return f"kmeans_run_{int(as_of.timestamp())}_{k}_{mark}"


def run_topics(
    items: DataFrame, cache: DataFrame, ids: DataFrame, root: str, k: int = topics.DEFAULT_TOPICS,
    as_of: dt.datetime | None = None, run_id: str | None = None, description: str | None = None, seed: int = 42,
    skip_projection: bool = False, skip_labels: bool = False, projection: dict | None = None,
    num_docs: int = 10, max_text_length: int = 500, labeller: Labeller | None = None, mart_keywords: int | None = None,
) -> RunResult:
    """Cluster the items of ``ids`` and write all results below ``root``.

    An error while fitting or assigning marks the run failed and is raised. Projection and labelling errors are
    recorded on the run and in the result, which stays usable without them. With ``mart_keywords`` the enriched mart of
    all items is written too, with so many keywords an item.
    """
    topics.check_topic_count(k)
    spark = items.sparkSession
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    run_id = run_id or new_run_id(ids, k, as_of)
    registry = f"{root}/kmeans_runs"
    _refuse_known(spark, registry, run_id)
    result = RunResult(run_id)
    seq = itertools.count()

    def note(status: str, **attributes) -> None:
        runs.record_run(spark, registry, run_id, next(seq), status, as_of, **attributes)

    model_path = f"{root}/models/{run_id}"
    note("submitted", num_topics=k, description=description, model_name=model_path)
    try:
        # Fitting, assignment and projection read the same vectors, so they are written once.
        vectors = cut(topics.item_vectors(items, cache, ids))
        # An id on two platforms would count twice in every topic.
        require_unique(vectors, ["unified_id"], "selected items")
        result.requested, result.found = ids.count(), vectors.count()
        _model_of(vectors)
        model = topics.fit_topics(vectors, k, seed)
        model.write().overwrite().save(model_path)
        note("model_created", model_creation_job_id=f"{run_id}_fit", embedding_model=_model_of(vectors))
        note("prediction_started", predict_job_id=f"{run_id}_predict")
        assigned = topics.assign_topics(vectors, topics.centers_of(spark, model))
        facts = cut(topics.topic_assignments(assigned, run_id, as_of))
        path = write_declared(facts, root, "document_topic_assignments")
        result.tables["assignments"] = path
        result.tables["predictions"] = write_declared(topics.predictions(facts), root, "kmeans_predictions")
        discard(facts)
        note("prediction_completed")
    except Exception as error:
        note(runs.FAILED, error_message=str(error))
        raise
    assignments = spark.read.parquet(path).filter(F.col("run_id") == run_id)

    def optional(stage: str, step: Callable[[], str]) -> None:
        try:
            result.tables[stage] = step()
        except Exception as error:  # kept in the result and on the run
            result.errors[stage] = str(error)
            note("prediction_completed", error_message=f"{stage}: {error}")

    if not skip_projection:
        optional("coordinates", lambda: _project(vectors, run_id, as_of, root, seed, projection or {}))
    if not skip_labels:
        optional("labels", lambda: _label(assignments, run_id, as_of, root, num_docs, max_text_length, labeller))
    if mart_keywords is not None:
        optional("mart", lambda: _mart(items, cache, assignments, result, run_id, as_of, root, mart_keywords))
    discard(vectors)
    note("completed", labeling_job_id=None if skip_labels else f"{run_id}_label")
    return result


def _model_of(vectors: DataFrame) -> str | None:
    """The one model that made the vectors; vectors of several models cannot be compared."""
    if "embedding_model_name" not in vectors.columns:
        return None
    names = [row[0] for row in vectors.select("embedding_model_name").distinct().take(2)]
    if len(names) > 1:
        raise QualityError(f"the vectors come from several models, for example {names[0]} and {names[1]}")
    return names[0] if names else None


def _refuse_known(spark, registry: str, run_id: str) -> None:
    try:
        known = spark.read.schema(runs.RUN_EVENTS).parquet(registry).filter(F.col("run_id") == run_id).take(1)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        known = []
    if known:
        raise QualityError(f"run {run_id} exists already")


def _project(vectors: DataFrame, run_id: str, as_of: dt.datetime, root: str, seed: int, options: dict) -> str:
    points = project(vectors.select("unified_id", "embeddings"), seed=seed, **options)
    rows = points.select(
        F.lit(run_id).alias("run_id"), F.lit(as_of).cast("timestamp").alias("created_at"), "unified_id",
        F.col("x").alias("umap_x"), F.col("y").alias("umap_y"),
    )
    return write_declared(cut(rows), root, "document_umap_coordinates")


def _label(
    assignments: DataFrame, run_id: str, as_of: dt.datetime, root: str, num_docs: int, max_text_length: int,
    labeller: Labeller | None,
) -> str:
    if labeller is None:
        labels = topics.label_topics(assignments, run_id, as_of, num_docs=num_docs)
    else:
        top = topics.topic_prompts(topics.top_documents(assignments, run_id, num_docs, max_text_length))
        answered = labeller(top.select("topic_id", "prompt")).select("topic_id", "response")
        labels = topics.parse_label_responses(top.join(answered, "topic_id", "left"), run_id, as_of)
    return write_declared(cut(labels), root, "topic_labels")


def _mart(
    items: DataFrame, cache: DataFrame, assignments: DataFrame, result: RunResult, run_id: str, as_of: dt.datetime, root: str, k: int
) -> str:
    lists = keywords(items.select("content_item_id", F.col("primary_text").alias("content")), k)
    labels = items.sparkSession.read.parquet(result.tables["labels"]) if "labels" in result.tables else None
    wide = cut(enriched_items(items, cache, as_of, lists, assignments, labels, run_id))
    path = write_declared(wide, root, "social_content_enriched")
    discard(wide)
    return path
