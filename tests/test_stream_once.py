"""Streams that fail between their writes and are started again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wattsift.operators.forest import META_SCHEMA, NODE_SCHEMA, Forest
from wattsift.operators.prep import fit_preprocessor
from wattsift.session import scratch_path
from wattsift.streaming import incremental
from wattsift.streaming.incremental import read_ledger, read_scores, read_versions, score_once


def _forest(spark, offset):
    nodes = spark.createDataFrame([(0, 1, -1, 0.0, 4, 0)], NODE_SCHEMA)
    return Forest(nodes, spark.createDataFrame([(1, 4, 24, 42, 0.05, offset)], META_SCHEMA))


@pytest.mark.parametrize("fails", ["before data", "before ledger", "after ledger"])
def test_each_record_is_scored_once_after_a_failure(spark, clean_frame, monkeypatch, fails):
    root, out, seen = (scratch_path(spark, x) for x in ("in", "out", "seen"))
    pre = fit_preprocessor(clean_frame)
    models = [("first", pre, _forest(spark, -0.4)), ("second", pre, _forest(spark, -0.6))]
    broken = {"armed": True}
    real = incremental.predict

    class Stop(RuntimeError):
        pass

    def predict(*a, **b):
        if fails == "before data" and broken["armed"]:
            raise Stop
        return real(*a, **b)

    monkeypatch.setattr(incremental, "predict", predict)
    schema = clean_frame.schema

    def run(model):
        return score_once(read_versions(spark, root, schema), out, seen, lambda: models[model], ("source_row_id",))

    if fails == "before ledger":
        class Blind:
            def __init__(self, *a):
                self.seen = incremental_observation(*a)

            @property
            def get(self):
                if broken["armed"]:
                    raise Stop
                return self.seen.get

        incremental_observation = incremental.Observation
        frame = type(clean_frame)
        observe = frame.observe
        monkeypatch.setattr(incremental, "Observation", Blind)
        monkeypatch.setattr(frame, "observe", lambda df, o, *e: observe(df, o.seen if isinstance(o, Blind) else o, *e))
    clean_frame.where("source_row_id < 12").write.parquet(f"{root}/version=2026-01-01")
    if fails == "after ledger":  # the batch is whole, but the stream has not noted it
        broken["armed"] = False
        run(0)
        import glob
        import os

        newest = max(glob.glob(f"{seen.removeprefix('file:')}/commits/[0-9]*"))
        os.remove(newest)
        crc = os.path.join(os.path.dirname(newest), f".{os.path.basename(newest)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    else:
        with pytest.raises(Exception, match="Stop"):
            run(0)
        broken["armed"] = False
    run(0)
    clean_frame.where("source_row_id >= 12").write.parquet(f"{root}/version=2026-01-02")
    run(1)
    run(1)
    found = read_scores(spark, out).collect()
    assert sorted(r["source_row_id"] for r in found) == list(range(20))
    assert {r["source_row_id"]: (r["model_key"], r["is_anomaly"]) for r in found} == {i: ("first", True) if i < 12 else ("second", False) for i in range(20)}
    assert sorted((r["rows"], r["model_key"]) for r in read_ledger(spark, out).collect()) == [(8, "second"), (12, "first")]


def test_what_no_ledger_names_is_not_read(spark, clean_frame):
    root, out, seen = (scratch_path(spark, x) for x in ("in", "out", "seen"))
    clean_frame.write.parquet(f"{root}/version=2026-01-01")
    score_once(read_versions(spark, root, clean_frame.schema), out, seen, lambda: ("m", fit_preprocessor(clean_frame), _forest(spark, -0.4)), ("source_row_id",))
    stray = read_scores(spark, out).withColumn("batch", F.lit(99).cast("long"))
    stray.write.parquet(f"{out}/data/query=scores-99")
    assert read_scores(spark, out).count() == 20
