"""Rows that may not get lost without a word, draws that reach every row, records that are not records."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattsift.operators.curve import as_scores, overall_diagnostics, score_curve, top_k_metrics, top_rate_threshold, type_diagnostics
from wattsift.operators.forest import fit_forest, tree_draws, tree_samples
from wattsift.operators.models import evaluate_saved, fit_model, row_vectors, records_from_json, save_model, train
from wattsift.operators.prep import fit_preprocessor, save_preprocessor
from wattsift.operators.registry import Registry
from wattsift.profile import ENERGY
from wattsift.session import scratch_path


def _scores(spark, rows):
    return as_scores(spark.createDataFrame(rows, "source_row_id long, score double, is_anomaly boolean"))


@pytest.mark.parametrize("bad", [(9, None, True), (9, math.nan, True), (9, 0.5, None)])
@pytest.mark.parametrize(
    "use",
    [score_curve, top_rate_threshold, overall_diagnostics, type_diagnostics, lambda s: top_k_metrics(s, (1,))],
)
def test_rows_without_a_score_or_label_raise(spark, bad, use):
    scores = _scores(spark, [(1, 0.1, False), (2, 0.9, True), bad])
    with pytest.raises(ValueError, match="1 of 3 rows"):
        use(scores)


def test_top_k_of_several_models(spark):
    rows = [("a", 1, 0.9, True), ("a", 2, 0.1, False), ("b", 1, 0.2, True), ("b", 2, 0.8, False)]
    scores = as_scores(spark.createDataFrame(rows, "model string, source_row_id long, score double, is_anomaly boolean"))
    found = {r["model"]: (r["precision_at_k"], r["recall_at_k"]) for r in top_k_metrics(scores, (1,)).collect()}
    assert found == {"a": (1.0, 1.0), "b": (0.0, 0.0)}


def test_trees_draw_from_the_whole_table(spark):
    data = spark.range(10_000).select(F.col("id").alias("row_id"), F.array(F.col("id").cast("double")).alias("features"))
    reached = set()
    for seed in range(40):
        rows = tree_samples(data, 5, 8, 10_000, seed, "row_id").collect()
        by_tree = {t: {int(r["features"][0]) for r in rows if r["tree"] == t} for t in range(5)}
        assert all(len(x) == 8 for x in by_tree.values())
        assert len({frozenset(x) for x in by_tree.values()}) == 5
        reached |= set().union(*by_tree.values())
    places = np.array(sorted(reached))
    assert len(reached) > 1_400 and np.histogram(places, bins=10, range=(0, 10_000))[0].min() > 100


def test_draws_do_not_depend_on_partitions(spark):
    data = spark.range(3_000).select(F.col("id").alias("row_id"), F.array(F.col("id").cast("double"), F.rand(1)).alias("features"))
    data = data.cache()
    one, many = (sorted(map(str, fit_forest(data.repartition(n), 5, 8, row_id="row_id").nodes.collect())) for n in (1, 7))
    assert one == many


def test_small_tables_are_drawn_whole(spark):
    data = spark.range(20).select(F.col("id").alias("row_id"), F.array(F.col("id").cast("double")).alias("features"))
    rows = tree_samples(data, 3, 20, 20, 1, "row_id").groupBy("tree").count().collect()
    assert sorted((r["tree"], r["count"]) for r in rows) == [(0, 20), (1, 20), (2, 20)]


def test_sparse_draws_are_even_over_rows_and_trees(spark):
    data = spark.range(20_000).selectExpr("id as row_id", "array(double(id)) as features")
    drawn = tree_draws(data, 50, 0.02, 3, "row_id").select("row_id", F.explode("draws").alias("e")).select("row_id", "e.*").toPandas()
    assert not drawn.duplicated(["row_id", "tree"]).any()
    expected = 20_000 * (1 - math.exp(-0.02))
    assert (abs(drawn.groupby("tree").size() - expected) < 6 * expected**0.5).all() and drawn.tree.nunique() == 50
    per_row = drawn.groupby("row_id").size().reindex(range(20_000), fill_value=0)
    assert abs(per_row.var() / (50 * (1 - math.exp(-0.02))) - math.exp(-0.02)) < 0.1  # independent trees
    assert abs((drawn["hash"] / 2.0**63).mean() - 0.5) < 0.01
    pairs = drawn.merge(drawn, on="row_id").query("tree_x == 0 and tree_y == 1")
    assert len(pairs) < 40  # about 8 rows are in both of two trees


@pytest.mark.parametrize("text", ["{broken", "[1,2]", "", None, '"x"', "{\"electricite_pct\": \"many\"}"])
def test_what_is_no_record_raises(spark, text):
    texts = spark.createDataFrame([(text,)], "body string")
    with pytest.raises(Exception, match="(?i)record|malformed"):
        records_from_json(texts, "body").collect()


def test_many_categories_are_not_fitted_in_one_task(clean_frame, capsys):
    from wattsift.operators.prep import category_counts, category_frequencies

    category_frequencies(category_counts(clean_frame, ENERGY.categoricals)).explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "Exchange SinglePartition" not in plan


def test_training_and_evaluation_leave_their_records(spark, clean_frame):
    registry = Registry.open(spark, scratch_path(spark, "registry"))
    from wattsift.sources.snapshots import publish

    path = scratch_path(spark, "data")
    run = registry.start_run({"operation": "publish"})
    data_id = registry.publish_dataset(run, publish(clean_frame, path), "clean")
    model_id = train(registry, path, scratch_path(spark, "models"), "2026-01-01", trees=5)
    values = {r["key"]: r["value"] for r in registry.table("run_values").collect()}
    assert float(values["training_seconds"]) > 0 and values["rows"] == "20" and values["features"] == "24"
    model = registry.table("models").first()
    assert model["id"] == model_id and model["metrics"]["rows"] == "20"
    assert registry.register_model(model["artifact_id"], model["name"], model["version"], data_id, {}) == model_id
    assert registry.table("models").count() == 1
    with pytest.raises(ValueError, match="already holds"):
        registry.register_model(model["artifact_id"], model["name"], "2026-02-02", data_id, {})

    labelled = clean_frame.withColumn("is_anomaly", F.col("source_row_id") > 16).withColumn("anomaly_type", F.lit("structural"))
    parts = {n: scratch_path(spark, n) for n in ("labelled", "forest", "pre")}
    labelled.write.parquet(parts["labelled"])
    pre = fit_preprocessor(clean_frame)
    save_preprocessor(pre, parts["pre"])
    save_model("isolation_forest", fit_model("isolation_forest", row_vectors(clean_frame, pre), trees=5), parts["forest"])
    evaluate_saved(spark, parts["forest"], parts["pre"], parts["labelled"], (2,), registry, model_id, data_id)
    evaluate_saved(spark, parts["forest"], parts["pre"], parts["labelled"], (2,), registry, model_id, None)
    experiments = registry.table("experiments").collect()
    assert len({e["id"] for e in experiments}) == 2 and all("evaluation_pr_auc" in e["metrics"] for e in experiments)
