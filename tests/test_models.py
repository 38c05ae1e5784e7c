"""Metrics, preparation, detectors, prediction, registry and streams."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattsift.operators import neighbours
from wattsift.operators.curve import as_scores, calculate_metrics, score_curve, top_k_metrics
from wattsift.operators.forest import Forest, fit_forest, load_forest, mean_path, save_forest, score_forest, with_decision
from wattsift.operators.models import MODELS, evaluate, fit_model, predict, predict_registered, records_from_json, row_vectors, train
from wattsift.operators.neighbours import fit_outlier_factor, nearest, score_outlier_factor
from wattsift.operators.one_class import fit_one_class, score_one_class
from wattsift.operators.prep import feature_vectors, fit_preprocessor, load_preprocessor, save_preprocessor, transform
from wattsift.operators.registry import Registry, current_runs, lineage
from wattsift.profile import ENERGY
from wattsift.session import scratch_path
from wattsift.sources.snapshots import content_digest, count_rows, publish, read_version, write_version, stored_bytes, table_digest
from wattsift.streaming.incremental import read_versions, run_available, score_stream


def _scores(spark, pairs):
    rows = [(i, float(s), bool(y)) for i, (s, y) in enumerate(pairs)]
    return as_scores(spark.createDataFrame(rows, "source_row_id long, score double, is_anomaly boolean"))


def test_ranking_metrics(spark):
    scores = _scores(spark, [(0.1, 0), (0.9, 1), (0.6, 0), (0.7, 1), (0.2, 0)])
    found = calculate_metrics(scores, ks=(2,))
    assert found["pr_auc"] == 1.0 and found["precision_at_2"] == 1.0 and found["recall_at_2"] == 1.0
    assert found["threshold"] == 0.7
    with pytest.raises(ValueError, match="no top"):
        top_k_metrics(scores, (6,))


def test_average_precision_is_a_step_sum(spark):
    found = calculate_metrics(_scores(spark, [(0.9, 1), (0.6, 0), (0.55, 1), (0.2, 0), (0.1, 0)]))
    assert found["pr_auc"] == pytest.approx(5 / 6) and found["roc_auc"] == pytest.approx(5 / 6)


def test_ties_and_single_class(spark):
    tied = calculate_metrics(_scores(spark, [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 1)]))
    assert tied["roc_auc"] == 0.5 and tied["pr_auc"] == 0.5
    none = calculate_metrics(_scores(spark, [(0.3, 0), (0.5, 0)]), ks=(1,))
    assert none["pr_auc"] is None and none["roc_auc"] is None and none["recall_at_1"] == 0.0 and none["threshold"] == 0.3
    every = calculate_metrics(_scores(spark, [(0.3, 1), (0.5, 1)]))
    assert every["pr_auc"] == 1.0 and every["roc_auc"] is None


def test_buckets_do_not_change_the_curve(spark):
    rng = np.random.default_rng(0)
    pairs = [(round(float(s), 2), y) for s, y in zip(rng.normal(size=2000), rng.random(2000) < 0.1, strict=True)]
    scores = _scores(spark, pairs + [(0.0, 0)] * 1000)
    one = sorted(map(tuple, score_curve(scores, ()).collect()))
    many = sorted(map(tuple, score_curve(scores, (), rows_per_bucket=100).collect()))
    assert one == many


def test_labels_are_required(clean_frame):
    with pytest.raises(ValueError, match="missing labels"):
        evaluate(clean_frame, None, None)


def test_preprocessor_shape_and_scale(clean_frame, spark):
    pre = fit_preprocessor(clean_frame)
    rows = feature_vectors(clean_frame, pre, ("source_row_id",)).collect()
    matrix = np.array([r["features"] for r in rows])
    assert matrix.shape == (20, 24) and np.isfinite(matrix).all()
    assert np.allclose(matrix.mean(0), 0, atol=1e-9)
    spread = matrix.std(0)
    assert np.all(np.isclose(spread, 1) | np.isclose(spread, 0))
    path = scratch_path(spark, "pre")
    save_preprocessor(pre, path)
    again = feature_vectors(clean_frame, load_preprocessor(spark, path), ("source_row_id",)).collect()
    assert {r[0]: r[1] for r in rows} == {r[0]: r[1] for r in again}
    unseen = transform(clean_frame.withColumn(ENERGY.context[0], F.lit("never seen")), pre).first()
    assert unseen[ENERGY.context[0]] == -1.0  # frequency 0, mean 1, scale 1


def _blob(spark, n=400, outliers=8, seed=1):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(0, 1, (n, 5)), rng.normal(9, 1, (outliers, 5))])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return x, spark.createDataFrame(rows, "row_id long, features array<double>").repartition(4)


def test_forest_finds_planted_rows(spark):
    _, data = _blob(spark)
    forest = fit_forest(data, trees=60, row_id="row_id")
    scored = with_decision(score_forest(data, forest), forest).toPandas().sort_values("row_id")
    assert scored["score_samples"].between(-1, 0).all()
    assert set(scored.nsmallest(8, "score_samples")["row_id"]) == set(range(400, 408))
    assert scored["is_anomaly"].sum() == 21  # strictly below the 5th percentile of 408 scores
    again = score_forest(data.repartition(9), fit_forest(data.repartition(2), trees=60, row_id="row_id")).toPandas()
    assert np.array_equal(again.sort_values("row_id")["score_samples"], scored["score_samples"])
    path = scratch_path(spark, "forest")
    save_forest(forest, path)
    loaded = load_forest(spark, path)
    assert loaded.meta.first()["offset"] == forest.meta.first()["offset"]
    sizes = forest.nodes.filter("feature >= 0 or depth = 0").groupBy("tree").agg(F.max("size")).select("max(size)").distinct().collect()
    assert [r[0] for r in sizes] == [256]


def test_mean_path():
    assert list(mean_path(np.array([0, 1, 2]))) == [0.0, 0.0, 1.0]
    assert mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def _brute(q, t, ids, k, skip=None):
    d = np.sqrt(((q[:, None] - t[None]) ** 2).sum(2))
    if skip is not None:
        d[skip[:, None] == ids[None]] = np.inf
    order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=1)[:, :k]
    return order, np.take_along_axis(d, order, 1)


@pytest.mark.parametrize("slice_rows", [32_768, 50, 16])
def test_neighbours_against_brute_force(spark, monkeypatch, slice_rows):
    """Small slices, packs, blocks and tiles, and a third of all rows being copies of one row."""
    sizes = {"SLICE_ROWS": slice_rows, "PACK_ROWS": 60, "BLOCK_ROWS": 32, "QUERY_BLOCK": 40, "TILE_ROWS": 30, "MERGE_PAIRS": 200}
    for name, value in sizes.items():
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(200, 6)) * 5, np.repeat(rng.normal(size=(1, 6)), 100, 0)])
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, features array<double>").repartition(3)
    ids = np.arange(len(x))
    for skip in (True, False):
        found = nearest(rows, rows, 7, skip).toPandas().sort_values(["row_id", "rank"])
        order, d = _brute(x, x, ids, 7, ids if skip else None)
        assert np.array_equal(found["neighbour_id"].to_numpy().reshape(-1, 7), order)
        assert np.allclose(found["distance"].to_numpy().reshape(-1, 7), d)


def _brute_factor(train, query, k):
    ids = np.arange(len(train))
    order, d = _brute(train, train, ids, k, ids)
    kd = d[:, -1]
    density = 1 / (np.maximum(d, kd[order]).mean(1) + 1e-10)
    qo, qd = _brute(query, train, ids, k)
    own = 1 / (np.maximum(qd, kd[qo]).mean(1) + 1e-10)
    fitted = -(density[order].mean(1) / density)
    return -(density[qo].mean(1) / own), np.percentile(fitted, 5)


def test_outlier_factor_against_brute_force(spark):
    x, data = _blob(spark, 150, 5)
    rng = np.random.default_rng(2)
    fresh = rng.normal(size=(30, 5))
    queries = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(fresh)], "row_id long, features array<double>")
    model = fit_outlier_factor(data, k=10)
    scores = score_outlier_factor(queries, model).toPandas().sort_values("row_id")
    expected, offset = _brute_factor(x, fresh, 10)
    assert np.allclose(scores["score_samples"], expected)
    assert model.offset == pytest.approx(offset)


def test_one_class_ranks_scattered_rows_last(spark):
    rng = np.random.default_rng(4)
    far = rng.normal(size=(6, 5))
    x = np.vstack([rng.normal(size=(400, 5)), 12 * far / np.linalg.norm(far, axis=1, keepdims=True)])
    data = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, features array<double>")
    scored = score_one_class(data, fit_one_class(data, components=128, steps=6)).toPandas()
    worst = scored["decision"].rank()[scored["row_id"] >= 400]
    assert worst.mean() < 60
    assert (scored["decision"] < 0).mean() == pytest.approx(0.05, abs=0.01)


def test_model_list():
    assert MODELS == ("isolation_forest", "lof", "one_class_svm")


def test_prediction_passes_scores_and_labels_through(spark, clean_frame):
    """A one-leaf forest gives every row the same score; the offset alone decides the flag."""
    pre = fit_preprocessor(clean_frame)
    nodes = spark.createDataFrame([(0, 1, -1, 0.0, 4, 0)], "tree int, node int, feature int, threshold double, size int, depth int")
    meta = "trees int, subsample int, features int, seed long, contamination double, offset double"
    record = {c: 0 for c in ENERGY.features} | {
        ENERGY.year: "2022", ENERGY.occupation: "1A", ENERGY.context[0]: "office", ENERGY.context[1]: "admin",
    }
    texts = spark.createDataFrame([(pd.Series(record).to_json(),)], "record string")
    for offset, flag in ((-0.4, True), (-0.6, False)):
        forest = Forest(nodes, spark.createDataFrame([(1, 4, 24, 42, 0.05, offset)], meta))
        row = predict(records_from_json(texts, "record"), pre, forest).first()
        assert row["anomaly_score"] == pytest.approx(-0.5) and row["is_anomaly"] is flag
    with pytest.raises(ValueError, match="Unsupported model"):
        predict(records_from_json(texts, "record"), pre, None, name="lof")


def test_registry_run(spark, clean_frame):
    registry = Registry.open(spark, scratch_path(spark, "registry"))
    with pytest.raises(LookupError, match="no dataset of the registry"):
        registry.require_dataset("nowhere")
    run = registry.start_run({"operation": "publish"})
    item = publish(clean_frame.coalesce(1), scratch_path(spark, "data"))
    assert item.row_count == 20 and count_rows(spark, item.object_key) == 20
    assert content_digest(spark, item.object_key)[1] == stored_bytes(spark, item.object_key) == item.size_bytes
    assert table_digest(spark.read.parquet(item.object_key)) == item.sha256
    first = registry.publish_dataset(run, item, "clean")
    assert registry.publish_dataset(run, item, "clean") == first
    with pytest.raises(ValueError, match="another name or size"):
        registry.publish_dataset(run, item, "another")
    changed = item.__class__(item.object_key, item.content_type, 20, "0" * 64, 1, ())
    with pytest.raises(ValueError, match="another content"):
        registry.register_artifact(run, changed, "dataset")
    registry.finish_run(run)
    with pytest.raises(LookupError, match="no finished run"):
        registry.resolve("isolation_forest")
    train(registry, item.object_key, scratch_path(spark, "models"), "2026-01-01", trees=10)
    found = predict_registered(registry, clean_frame, ("source_row_id",), version="2026-01-01").collect()
    assert len(found) == 20
    with pytest.raises(Exception, match="no finished run"):
        registry.resolve("isolation_forest", "2030-01-01")
    with pytest.raises(Exception):
        train(registry, item.object_key, scratch_path(spark, "models"), "2026-01-02", trees=0)
    registry.log_values(run, "metric", spark.createDataFrame([(0.5, 3)], "pr_auc double, n long"))
    assert {r["key"]: r["value"] for r in registry.table("run_values").collect() if r["run_id"] == run} == {"pr_auc": "0.5", "n": "3"}
    registry.register_experiment(run, None, first, {"seed": "42"}, {"pr_auc": "0.5"})
    assert registry.table("experiments").first()["evaluation_dataset_id"] == first
    states = sorted(r["status"] for r in registry.runs().collect())
    assert states == ["completed", "completed", "failed"]


def test_versions_on_disk(spark, clean_frame):
    root = scratch_path(spark, "versions")
    write_version(clean_frame, root, "2026-01-01")
    write_version(clean_frame.limit(3), root, "2026-01-02")
    assert read_version(spark, root, "2026-01-02").count() == 3
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        write_version(clean_frame, root, "2026-01-01")
    with pytest.raises(ValueError, match="Version must look like"):
        write_version(clean_frame, root, "latest")


def test_lineage_cycle_is_an_error(spark):
    chain = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c")], "id string, source_dataset_id string")
    assert {r["id"]: (r["root_id"], r["depth"]) for r in lineage(chain).collect()} == {x: ("a", i) for i, x in enumerate("abcd")}
    ring = spark.createDataFrame([("a", "c"), ("b", "a"), ("c", "b")], "id string, source_dataset_id string")
    with pytest.raises(ValueError, match="cycle"):
        lineage(ring)


def test_stream_scores_like_the_batch(spark, clean_frame):
    pre = fit_preprocessor(clean_frame)
    forest = fit_model("isolation_forest", row_vectors(clean_frame, pre), trees=10)
    root, out, seen = (scratch_path(spark, x) for x in ("in", "out", "seen"))
    schema = T.StructType([*clean_frame.schema.fields, T.StructField("version", T.StringType())])
    for version, part in (("2026-01-01", clean_frame.filter("source_row_id < 12")), ("2026-01-02", clean_frame.filter("source_row_id >= 12"))):
        write_version(part, root, version)
        run_available(score_stream(read_versions(spark, root, schema), pre, forest, ("source_row_id",)), out, seen)
    streamed = {r["source_row_id"]: r["anomaly_score"] for r in spark.read.parquet(out).collect()}
    batch = {r["source_row_id"]: r["anomaly_score"] for r in predict(clean_frame, pre, forest, ("source_row_id",)).collect()}
    assert streamed == batch and len(batch) == 20


def test_run_events(spark):
    at = datetime(2026, 1, 1)
    rows = [("r", "running", None, at), ("r", "completed", at, at)]
    events = spark.createDataFrame(rows, "id string, status string, finished_at timestamp, event_at timestamp")
    assert current_runs(events).first()["status"] == "completed"


def test_category_lookup_is_the_same_by_constant_and_by_join(spark, clean_frame):
    from wattsift.operators.prep import encode_categories

    pre = fit_preprocessor(clean_frame)
    mixed = clean_frame.withColumn(ENERGY.year, F.when(F.col("source_row_id") < 5, None).when(F.col("source_row_id") < 9, "1999").otherwise("2022"))
    ways = [
        sorted(map(tuple, encode_categories(mixed, pre, **limits).select("source_row_id", *ENERGY.categoricals).collect()))
        for limits in ({}, {"literal_rows": 0}, {"literal_rows": 0, "broadcast_rows": 0})
    ]
    assert ways[0] == ways[1] == ways[2]
    assert [r[1] for r in ways[0]] == [1.0] * 5 + [0.0] * 4 + [1.0] * 11


def test_one_class_lifts_a_few_rows_at_once(spark, monkeypatch):
    """A batch is lifted in parts that fit a core's cache, and the fitted scores are stored before they are ranked."""
    from wattsift.operators import one_class

    x = np.random.default_rng(3).normal(size=(500, 4))
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, features array<double>").coalesce(1)
    whole = one_class.fit_one_class(rows, 0.1, components=16, steps=3)
    stored, write = [], one_class.materialise
    monkeypatch.setattr(one_class, "materialise", lambda df, label: stored.append(label) or write(df, label))
    monkeypatch.setattr(one_class, "LIFT_ROWS", 64)
    parts = one_class.fit_one_class(rows, 0.1, components=16, steps=3)
    assert stored == ["one-class-fit"]
    scores = [one_class.score_one_class(rows, m).orderBy("row_id").toPandas()["decision"].to_numpy() for m in (whole, parts)]
    assert np.allclose(*scores, atol=1e-9)
    assert [len(z) for z in one_class._lifted(rows.toArrow().combine_chunks().to_batches()[0], np.ones((4, 16)), np.zeros(16))] == [64] * 7 + [52]
