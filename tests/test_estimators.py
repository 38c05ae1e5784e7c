"""Pipeline stages against the functions they stand for, before and after a round through files."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from tables import CLEAN_SCHEMA, clean_rows

from wattsift.estimators import ForestDetector, Preparation, profile_from_text, profile_text
from wattsift.operators.models import predict
from wattsift.profile import ENERGY
from wattsift.session import scratch_path


def test_a_saved_pipeline_predicts_what_functions_do(spark):
    rows = spark.createDataFrame(clean_rows(80), CLEAN_SCHEMA).withColumn("note", F.lit("kept"))
    unfitted, fitted = scratch_path(spark, "pipeline"), scratch_path(spark, "fitted")
    Pipeline(stages=[Preparation(), ForestDetector(trees=12, maxSamples=32, seed=3)]).write().save(unfitted)
    model = Pipeline.load(unfitted).fit(rows)
    model.write().save(fitted)
    read = PipelineModel.load(fitted)
    assert [s.uid for s in read.stages] == [s.uid for s in model.stages]
    assert read.stages[1].getOrDefault("trees") == 12 and read.stages[0].get_profile() == ENERGY
    found = read.transform(rows)
    assert found.columns == [*rows.columns, "anomaly_score", "is_anomaly"]
    keep = (ENERGY.row_id,)
    wanted = predict(rows, model.stages[0].state, model.stages[1].state, keep).orderBy(*keep).collect()
    assert found.select(*keep, "anomaly_score", "is_anomaly").orderBy(*keep).collect() == wanted
    same = found.select(*rows.columns)
    assert same.exceptAll(rows).isEmpty() and rows.exceptAll(same).isEmpty()
    found.createOrReplaceTempView("predicted_rows")
    assert spark.sql("select count(*) from predicted_rows where is_anomaly").first()[0] == sum(r.is_anomaly for r in wanted)
    with pytest.raises(ValueError, match="is_anomaly"):
        read.transform(rows.withColumn("is_anomaly", F.lit(True)))


def test_profiles_are_read_as_written():
    other = replace(ENERGY, row_id="number")
    assert profile_from_text(profile_text(other)) == other
    assert Preparation(profile=profile_text(other)).get_profile().row_id == "number"
