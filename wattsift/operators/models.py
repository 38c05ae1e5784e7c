"""Detectors behind one score direction; prediction, evaluation and comparison."""

from __future__ import annotations

import time
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsift.operators import forest, neighbours, one_class, one_class_dual
from wattsift.operators.clean import require_labels
from wattsift.operators.curve import OVERALL, as_scores, curve_metrics, metrics_long, score_curve, top_k_metrics
from wattsift.operators.forest import Forest
from wattsift.operators.prep import Preprocessor, feature_vectors, fit_preprocessor, load_preprocessor, save_preprocessor
from wattsift.operators.registry import Registry
from wattsift.profile import ANOMALY_TYPES, ENERGY, Profile
from wattsift.session import materialise, spread
from wattsift.sources.snapshots import PARQUET, Published, content_digest, load_features

MODELS = ("isolation_forest", "lof", "one_class_svm")
SERVED = ("isolation_forest",)

CONFIGURATIONS: dict[str, dict[str, Any]] = {
    "isolation_forest": {"trees": 200, "max_samples": 256, "contamination": 0.05},
    "lof": {"k": 35, "contamination": 0.05},
    "one_class_svm": {"nu": 0.05},
    "one_class_dual": {"nu": 0.05},
}
_SAVE = {
    "isolation_forest": forest.save_forest, "lof": neighbours.save_outlier_factor, "one_class_svm": one_class.save_one_class,
    "one_class_dual": one_class_dual.save_one_class_dual,
}
_LOAD = {
    "isolation_forest": forest.load_forest, "lof": neighbours.load_outlier_factor, "one_class_svm": one_class.load_one_class,
    "one_class_dual": one_class_dual.load_one_class_dual,
}


def fit_model(name: str, vectors: DataFrame, seed: int = 42, **overrides: Any):
    """``vectors``: row_id, features."""
    options = {**CONFIGURATIONS[name], **overrides}
    if name == "isolation_forest":
        return forest.fit_forest(vectors, seed=seed, row_id="row_id", **options)
    if name == "lof":
        return neighbours.fit_outlier_factor(vectors, seed=seed, **options)
    if name == "one_class_dual":
        return one_class_dual.fit_one_class_dual(vectors, seed=seed, **options)
    return one_class.fit_one_class(vectors, seed=seed, **options)


def anomaly_scores(name: str, model: Any, vectors: DataFrame) -> DataFrame:
    """(row_id, score) with higher always more anomalous, whatever the detector's own sign."""
    if name == "isolation_forest":
        scored = forest.with_decision(forest.score_forest(vectors.select("row_id", "features"), model), model)
        return scored.select("row_id", (-F.col("decision")).alias("score"))
    if name == "lof":
        scored = neighbours.score_outlier_factor(vectors, model)
        return scored.select("row_id", (-F.col("score_samples")).alias("score"))
    score = one_class_dual.score_one_class_dual if name == "one_class_dual" else one_class.score_one_class
    scored = score(vectors.select("row_id", "features"), model)
    return scored.select("row_id", (-F.col("decision")).alias("score"))


def save_model(name: str, model: Any, path: str) -> None:
    _SAVE[name](model, path)


def load_model(name: str, spark: SparkSession, path: str) -> Any:
    return _LOAD[name](spark, path)


def row_vectors(df: DataFrame, pre: Preprocessor, profile: Profile = ENERGY, keep: tuple[str, ...] = ()) -> DataFrame:
    """(row_id, features, kept columns)."""
    return feature_vectors(df, pre, (profile.row_id, *keep), profile).withColumnRenamed(profile.row_id, "row_id")


def stored_vectors(df: DataFrame, pre: Preprocessor, profile: Profile = ENERGY, keep: tuple[str, ...] = (), label: str = "vectors") -> DataFrame:
    """The same, written once and spread over all cores: detectors read it many times and compute much per row."""
    return spread(materialise(row_vectors(df, pre, profile, keep), label))


# ---- prediction ----


def records_schema(profile: Profile = ENERGY) -> str:
    kinds = {c: "double" for c in profile.numeric}
    return ", ".join(f"{c} {kinds.get(c, 'string')}" for c in profile.features)


def records_from_json(texts: DataFrame, column: str, profile: Profile = ENERGY) -> DataFrame:
    """One JSON object per row to the feature columns; other columns are kept.

    A text that is not one JSON object, or has a value of another type, raises when the rows are read.
    """
    whole = F.col(column).isNotNull() & F.startswith(F.ltrim(F.col(column)), F.lit("{"))
    broken = F.raise_error(F.concat(F.lit("Not a record: "), F.coalesce(F.col(column), F.lit("null"))))
    checked = F.when(whole, F.col(column)).otherwise(broken)
    parsed = texts.withColumn("__record", F.from_json(checked, records_schema(profile), {"mode": "FAILFAST"}))
    flat = parsed.select(*[c for c in texts.columns if c != column], "__record.*")
    return flat.withColumn(profile.mono_flag, F.col(profile.mono_flag).try_cast("boolean"))


def predict(records: DataFrame, pre: Preprocessor, model: Forest, keep: tuple[str, ...] = (), name: str = "isolation_forest", profile: Profile = ENERGY) -> DataFrame:
    """(kept columns, anomaly_score, is_anomaly); the score is the detector's own: lower is more anomalous.

    Row-local apart from lookups in the fitted tables, so it serves batches and streams alike.
    """
    if name not in SERVED:
        raise ValueError(f"Unsupported model: {name}")
    vectors = feature_vectors(records, pre, keep, profile)
    scored = forest.with_decision(forest.score_forest(vectors, model), model)
    return scored.select(*keep, F.col("score_samples").alias("anomaly_score"), "is_anomaly")


def predict_registered(registry: Registry, records: DataFrame, keep: tuple[str, ...] = (), name: str = "isolation_forest", version: str | None = None) -> DataFrame:
    """Predict with the latest completed model of the registry (or of one version)."""
    if name not in SERVED:
        raise ValueError(f"Unsupported model: {name}")
    refs = registry.resolve(name, version)
    pre = load_preprocessor(registry.spark, refs["preprocessor_key"])
    return predict(records, pre, load_model(name, registry.spark, refs["model_key"]), keep, name)


# ---- evaluation ----


def evaluate(
    labelled: DataFrame, pre: Preprocessor, model: Forest, ks: Sequence[int] = (), profile: Profile = ENERGY
) -> tuple[DataFrame, DataFrame | None]:
    """(metrics overall and per type at the best-F1 threshold, top-k table) with scores negated."""
    require_labels(labelled)
    vectors = feature_vectors(labelled, pre, (profile.row_id, "is_anomaly", "anomaly_type"), profile)
    scored = forest.score_forest(vectors, model).withColumn("score", -F.col("score_samples"))
    scores = materialise(as_scores(scored, row_id=profile.row_id), "evaluation-scores")
    metrics = curve_metrics(score_curve(scores))
    return metrics, top_k_metrics(scores, ks, ANOMALY_TYPES) if ks else None


def evaluate_saved(
    spark: SparkSession, model_path: str, preprocessor_path: str, labelled_path: str, ks: Sequence[int] = (100,),
    registry: Registry | None = None, model_id: str | None = None, dataset_id: str | None = None,
):
    """Evaluate persisted model tables on a persisted labelled set.

    With a registry the evaluation is a run of its own: its metrics are logged and stored as an experiment.
    """
    labelled = spark.read.parquet(labelled_path)
    pre, model = load_preprocessor(spark, preprocessor_path), forest.load_forest(spark, model_path)
    if registry is None:
        return evaluate(labelled, pre, model, ks)
    setting = {"operation": "evaluate", "model": model_path, "labelled": labelled_path}
    run_id = registry.start_run(setting)
    try:
        metrics, at_k = evaluate(labelled, pre, model, ks)
        found = metrics_long(metrics, ("pr_auc", "roc_auc", "precision", "recall", "f1", "threshold")).collect()  # a few per type
        values = {r["metric"]: str(r["value"]) for r in found}
        registry.log_values(run_id, "metric", spark.createDataFrame([values]))
        registry.register_experiment(run_id, model_id, dataset_id, setting, values)
        registry.finish_run(run_id)
    except Exception as failure:
        registry.finish_run(run_id, str(failure))
        raise
    return metrics, at_k


# ---- training run with its records ----


def _published(spark: SparkSession, path: str) -> Published:
    digest, size = content_digest(spark, path)
    return Published(path, PARQUET, 0, digest, size, ())


def train(registry: Registry, dataset_path: str, model_root: str, version: str, seed: int = 42, profile: Profile = ENERGY, **overrides: Any) -> str:
    """Fit, persist and register a forest on a registered dataset; a failure is recorded and raised again."""
    spark = registry.spark
    dataset_id = registry.require_dataset(dataset_path)
    run_id = registry.start_run({"operation": "train", "dataset": dataset_path, "version": version, "seed": str(seed)})
    try:
        features = load_features(spark, dataset_path, profile)
        pre = fit_preprocessor(features, profile)
        keyed = spark.read.parquet(dataset_path)
        vectors = stored_vectors(keyed, pre, profile)
        started = time.perf_counter()
        model = fit_model("isolation_forest", vectors, seed, **overrides)
        measured = {"training_seconds": time.perf_counter() - started, "rows": keyed.count(), "features": len(profile.features)}
        root = f"{model_root}/version={version}"
        save_model("isolation_forest", model, f"{root}/model")
        save_preprocessor(pre, f"{root}/preprocessor")
        model_artifact = registry.register_artifact(run_id, _published(spark, f"{root}/model"), "model")
        registry.register_artifact(run_id, _published(spark, f"{root}/preprocessor"), "preprocessor")
        settings = {k: str(v) for k, v in {**CONFIGURATIONS["isolation_forest"], **overrides, "seed": seed}.items()}
        metrics = {k: str(v) for k, v in measured.items()}
        model_id = registry.register_model(model_artifact, "isolation_forest", version, dataset_id, settings, metrics)
        registry.log_values(run_id, "parameter", spark.createDataFrame([settings]))
        registry.log_values(run_id, "metric", spark.createDataFrame([metrics]))
        registry.finish_run(run_id)
    except Exception as failure:
        registry.finish_run(run_id, str(failure))
        raise
    return model_id


# ---- comparison of detectors ----


def compare_models(
    clean: DataFrame,
    labelled: DataFrame,
    names: Sequence[str] = MODELS,
    seed: int = 42,
    top_rate: float = 0.05,
    model_root: str | None = None,
    profile: Profile = ENERGY,
    overrides: dict[str, dict[str, Any]] | None = None,
    registry: Registry | None = None,
    dataset_id: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(results per model, long score table): fit on clean rows, score labelled rows, top-rate threshold.

    Only scores are kept per model; all metrics come from one curve grouped by model.  With ``model_root`` each model
    is saved there and scored as read back.  With a registry the comparison is a run, and each model an experiment
    of it on ``dataset_id``.
    """
    if registry is None:
        return _compare(clean, labelled, names, seed, top_rate, model_root, profile, overrides or {})
    setting = {"operation": "compare", "seed": str(seed), "top_rate": str(top_rate), "models": ",".join(names)}
    run_id = registry.start_run(setting)
    try:
        results, long = _compare(clean, labelled, names, seed, top_rate, model_root, profile, overrides or {})
        for r in results.collect():  # one per model
            options = {**CONFIGURATIONS[r["model"]], **(overrides or {}).get(r["model"], {}), "model": r["model"], "seed": seed}
            measured = {**r["test_metrics"].asDict(), **r["configuration"].asDict()}
            registry.register_experiment(run_id, None, dataset_id, {k: str(v) for k, v in options.items()}, {k: str(v) for k, v in measured.items()})
        registry.finish_run(run_id)
    except Exception as failure:
        registry.finish_run(run_id, str(failure))
        raise
    return results, long


def _compare(clean, labelled, names, seed, top_rate, model_root, profile, overrides) -> tuple[DataFrame, DataFrame]:
    require_labels(labelled)
    spark = clean.sparkSession
    pre = fit_preprocessor(clean, profile)
    if model_root:
        save_preprocessor(pre, f"{model_root}/preprocessor")
    train_rows = stored_vectors(clean, pre, profile)
    test_rows = stored_vectors(labelled, pre, profile, ("is_anomaly", "anomaly_type"))
    scores: DataFrame | None = None
    timings = []
    for name in names:
        started = time.perf_counter()
        model = fit_model(name, train_rows, seed, **overrides.get(name, {}))
        fitted = time.perf_counter()
        if model_root:
            save_model(name, model, f"{model_root}/{name}")
            model = load_model(name, spark, f"{model_root}/{name}")
            saved = time.perf_counter()
        part = materialise(anomaly_scores(name, model, test_rows).withColumn("model", F.lit(name)), f"scores-{name}")
        timings.append((name, fitted - started, time.perf_counter() - (saved if model_root else fitted)))
        scores = part if scores is None else scores.unionByName(part)
    labels = test_rows.select("row_id", "is_anomaly", "anomaly_type")
    long = materialise(as_scores(scores.join(labels, "row_id"), row_id="row_id"), "scores")
    metrics = curve_metrics(score_curve(long), top_rate=top_rate)
    sizes = (clean.count(), labelled.count())
    return _results(spark, metrics, timings, sizes), long


def _metric_struct() -> Column:
    return F.struct("pr_auc", "roc_auc", "precision", "recall", "f1", "threshold")


def _results(spark: SparkSession, metrics: DataFrame, timings: list, sizes: tuple[int, int]) -> DataFrame:
    """Nested rows laid out as ``sources.reports`` reads them."""
    overall = metrics.filter(F.col("anomaly_type") == OVERALL).select("model", _metric_struct().alias("test_metrics"))
    family = metrics.filter(F.col("anomaly_type") != OVERALL).groupBy("model").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("anomaly_type", _metric_struct())))).alias("per_type_metrics")
    )
    clock = spark.createDataFrame(timings, "model string, training_seconds double, inference_seconds double")
    return (
        overall.join(F.broadcast(family), "model", "left")
        .join(F.broadcast(clock), "model")
        .select(
            "model",
            F.struct("training_seconds", "inference_seconds").alias("configuration"),
            F.lit(sizes[0]).cast("long").alias("training_rows"),
            F.lit(0).cast("long").alias("validation_rows"),
            F.lit(sizes[1]).cast("long").alias("test_rows"),
            "test_metrics",
            "per_type_metrics",
        )
    )
