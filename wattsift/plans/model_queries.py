"""Queries over detectors, prediction, evaluation and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattsift.operators.curve import curve_metrics, score_curve
from wattsift.operators.forest import Forest, score_forest, with_decision
from wattsift.operators.models import (
    anomaly_scores,
    compare_models,
    evaluate,
    fit_model,
    predict,
    predict_registered,
    records_from_json,
    stored_vectors,
    train,
)
from wattsift.operators.neighbours import (
    add_rows,
    build_index,
    fit_outlier_factor,
    load_index,
    nearest,
    save_index,
    score_outlier_factor,
    search_index,
)
from wattsift.operators.prep import Preprocessor, fit_preprocessor
from wattsift.operators.registry import Registry
from wattsift.plans.catalog import query
from wattsift.plans.energy_view import table
from wattsift.plans.oracle_parts import P
from wattsift.plans.shared import clean_energy, labelled_energy, once, r6
from wattsift.session import materialise, scratch_path
from wattsift.sources.reports import comparison, per_type
from wattsift.sources.snapshots import publish
from wattsift.streaming.incremental import read_versions, run_available, score_stream


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("row_id"), F.transform("embedding", lambda x: x.cast("double")).alias("features")
    )


def _preprocessor(spark, sf_dir) -> Preprocessor:
    return once("preprocessor", spark, sf_dir, lambda: fit_preprocessor(clean_energy(spark, sf_dir)))


def _clean_vectors(spark, sf_dir) -> DataFrame:
    return once(
        "vectors", spark, sf_dir, lambda: stored_vectors(clean_energy(spark, sf_dir), _preprocessor(spark, sf_dir))
    )


def _forest(spark, sf_dir) -> Forest:
    return once("forest", spark, sf_dir, lambda: fit_model("isolation_forest", _clean_vectors(spark, sf_dir)))


# ---- neighbours, with SQL ----

_PAIRS = """e as (select cast(vec_id as bigint) as row_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
 gaps as (select a.row_id, b.row_id as neighbour_id, list_distance(a.v, b.v) as distance from e a, e b),
 others as (select *, row_number() over (partition by row_id order by distance, neighbour_id) as rank from gaps where row_id <> neighbour_id)"""

_FIT = f"""{_PAIRS}, knn as (select * from others where rank <= 35),
 kdist as (select row_id, max(distance) as k_distance from knn group by row_id),
 dens as (select k.row_id, 1 / (avg(greatest(k.distance, d.k_distance)) + 1e-10) as density from knn k join kdist d on d.row_id = k.neighbour_id group by k.row_id)"""


@query(
    "knn_join",
    f"with {_PAIRS} select row_id, neighbour_id, round(distance, 6) as distance, cast(rank as integer) as rank from others where rank <= 10",
)
def knn_join(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    return nearest(vectors, vectors, 10, skip_self=True).select("row_id", "neighbour_id", r6("distance"), "rank")


@query(
    "knn_join_distributed",
    f"with {_PAIRS} select row_id, neighbour_id, round(distance, 6) as distance, cast(rank as integer) as rank from others where rank <= 10",
)
def knn_join_distributed(spark, sf_dir):
    """The same for queries that are not the training rows' own table: here a copy in another order."""
    vectors = _vectors(spark, sf_dir)
    found = nearest(vectors.repartition(16, "row_id"), vectors, 10, skip_self=True)
    return found.select("row_id", "neighbour_id", r6("distance"), F.col("rank").cast("int").alias("rank"))


@query(
    "knn_index_added",
    """with e as (select cast(vec_id as bigint) as row_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
 gaps as (select a.row_id, b.row_id as neighbour_id, list_distance(list_reverse(a.v), b.v) as distance from e a, e b),
 ranked as (select *, row_number() over (partition by row_id order by distance, neighbour_id) as rank from gaps)
 select row_id, neighbour_id, round(distance, 6) as distance, cast(rank as integer) as rank from ranked where rank <= 5""",
)
def knn_index_added(spark, sf_dir):
    """An index of two thirds of the vectors is stored and read, the last third added to it; all vectors, their
    components in the opposite order, look for their neighbours in it."""
    vectors, path = _vectors(spark, sf_dir), scratch_path(spark, "index")
    late = F.col("row_id") % 3 == 0
    save_index(build_index(vectors.filter(~late), 5), path)
    index = add_rows(load_index(spark, path), vectors.filter(late))
    found, _ = search_index(vectors.select("row_id", F.reverse("features").alias("features")), index, 5)
    return found.select("row_id", "neighbour_id", r6("distance"), F.col("rank").cast("int").alias("rank"))


@query("lof_fit", f"with {_FIT} select row_id, round(k_distance, 6) as k_distance, round(density, 5) as density from kdist join dens using (row_id)")
def lof_fit(spark, sf_dir):
    model = fit_outlier_factor(_vectors(spark, sf_dir))
    return model.rows.select("row_id", r6("k_distance"), F.round("density", 5).alias("density"))


@query(
    "lof_scores",
    f"""with {_FIT}, near as (select * from (select *, row_number() over (partition by row_id order by distance, neighbour_id) as rk from gaps) t where rk <= 35)
 select n.row_id, round(-avg(d.density) * (avg(greatest(n.distance, k.k_distance)) + 1e-10), 5) as score_samples
 from near n join kdist k on k.row_id = n.neighbour_id join dens d on d.row_id = n.neighbour_id group by n.row_id""",
)
def lof_scores(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    scored = score_outlier_factor(vectors, fit_outlier_factor(vectors))
    return scored.select("row_id", F.round("score_samples", 5).alias("score_samples"))


# ---- detectors without an SQL form ----


@query("iforest_scores")
def iforest_scores(spark, sf_dir):
    return score_forest(_clean_vectors(spark, sf_dir), _forest(spark, sf_dir)).select("row_id", r6("score_samples"))


@query("iforest_flags")
def iforest_flags(spark, sf_dir):
    forest = _forest(spark, sf_dir)
    scored = with_decision(score_forest(_clean_vectors(spark, sf_dir), forest), forest)
    return scored.select("row_id", r6("decision"), "is_anomaly")


@query("iforest_nodes")
def iforest_nodes(spark, sf_dir):
    """Shape of the fitted trees by depth."""
    nodes = _forest(spark, sf_dir).nodes
    return nodes.groupBy("depth").agg(F.count(F.lit(1)).alias("nodes"), F.sum("size").alias("rows"))


@query("iforest_embeddings")
def iforest_embeddings(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    return anomaly_scores("isolation_forest", fit_model("isolation_forest", vectors), vectors).select("row_id", r6("score"))


@query("ocsvm_rff_scores")
def ocsvm_rff_scores(spark, sf_dir):
    vectors = _clean_vectors(spark, sf_dir)
    return anomaly_scores("one_class_svm", fit_model("one_class_svm", vectors), vectors).select("row_id", r6("score"))


@query("predict_records")
def predict_records(spark, sf_dir):
    """Clean rows as JSON records, parsed and predicted."""
    texts = clean_energy(spark, sf_dir).select("source_row_id", F.to_json(F.struct(*P.features)).alias("record"))
    records = records_from_json(texts, "record")
    found = predict(records, _preprocessor(spark, sf_dir), _forest(spark, sf_dir), ("source_row_id",))
    return found.select("source_row_id", r6("anomaly_score"), "is_anomaly")


@query("predict_registered")
def predict_registered_rows(spark, sf_dir):
    """Publish, register, train, resolve, predict: a whole run over registry tables."""
    registry = Registry.open(spark, scratch_path(spark, "registry"))
    run = registry.start_run({"operation": "publish"})
    item = publish(clean_energy(spark, sf_dir), scratch_path(spark, "dataset"))
    registry.publish_dataset(run, item, "clean")
    registry.finish_run(run)
    train(registry, item.object_key, scratch_path(spark, "models"), "2026-01-01")
    found = predict_registered(registry, clean_energy(spark, sf_dir), ("source_row_id",))
    return found.select("source_row_id", r6("anomaly_score"), "is_anomaly")


@query("evaluate_model")
def evaluate_model(spark, sf_dir):
    metrics, _ = evaluate(labelled_energy(spark, sf_dir), _preprocessor(spark, sf_dir), _forest(spark, sf_dir))
    return metrics.select("model", "anomaly_type", "rows", "anomaly_count", r6("pr_auc"), r6("roc_auc"), r6("f1"), r6("threshold"))


@query("compare_models")
def compare_model_rows(spark, sf_dir):
    results, _ = _compared(spark, sf_dir)
    return comparison(results).drop("training_seconds", "inference_seconds")


@query("compare_models_by_type")
def compare_models_by_type(spark, sf_dir):
    results, _ = _compared(spark, sf_dir)
    return per_type(results)


@query("compare_models_curve")
def compare_models_curve(spark, sf_dir):
    """Best-F1 metrics of all detectors from the stored score table."""
    _, scores = _compared(spark, sf_dir)
    return curve_metrics(score_curve(scores))


def _compared(spark, sf_dir):
    def build():
        results, scores = compare_models(clean_energy(spark, sf_dir), labelled_energy(spark, sf_dir))
        return materialise(results, "results"), scores

    return once("compared", spark, sf_dir, build)


@query("stream_scores")
def stream_scores(spark, sf_dir):
    """Clean rows arriving as two versions, predicted by a stream as they come."""
    root, out, seen = (scratch_path(spark, x) for x in ("score-in", "score-out", "score-seen"))
    rows = clean_energy(spark, sf_dir).withColumn("version", F.when(F.col(P.mono_flag), "a").otherwise("b"))
    pre, forest = _preprocessor(spark, sf_dir), _forest(spark, sf_dir)
    for version in ("a", "b"):
        rows.filter(F.col("version") == version).drop("version").write.parquet(f"{root}/version={version}")
        stream = read_versions(spark, root, rows.schema)
        run_available(score_stream(stream, pre, forest, ("source_row_id", "version")), out, seen)
    return spark.read.parquet(out).select("source_row_id", "version", r6("anomaly_score"), "is_anomaly")
