"""Summaries of versions against fits from scratch."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from tables import CLEAN_SCHEMA, clean_rows

from wattsift.operators.prep import fit_preprocessor
from wattsift.profile import ENERGY
from wattsift.session import scratch_path
from wattsift.sources.snapshots import write_version
from wattsift.streaming.summaries import fit_summarised, read_categories, summarise, update_summaries


def _shown(pre):
    stats = {r["feature"]: r for r in pre.stats.collect()}
    return stats, {(r["feature"], r["value"]): r["frequency"] for r in pre.frequencies.collect()}


def _same(a, b):
    (stats, shares), (other, other_shares) = _shown(a), _shown(b)
    assert stats.keys() == other.keys() and shares == pytest.approx(other_shares)
    for name, r in stats.items():
        o = other[name]
        assert (r["kind"], r["fill_text"], r["fill_number"]) == (o["kind"], o["fill_text"], o["fill_number"]), name
        assert (r["mean"], r["scale"]) == pytest.approx((o["mean"], o["scale"])), name


@pytest.mark.parametrize("direct_rows", [1_000_000, 2])
def test_a_third_version(spark, direct_rows):
    """Nulls, a column that is null in one version and one that is null in all, new categories, skewed sizes; with few
    direct rows the sketch's bracket is used."""
    rows = spark.createDataFrame(clean_rows(300), CLEAN_SCHEMA)
    number, empty = ENERGY.ratios[0], ENERGY.splits[1]
    rows = rows.withColumns(
        {
            number: F.when(F.col("source_row_id") % 7 != 0, F.col(number) * F.col("source_row_id")),
            ENERGY.ratios[1]: F.when(F.col("source_row_id") >= 200, F.col(ENERGY.ratios[1])),
            empty: F.lit(None).cast("double"),
            ENERGY.context[0]: F.when(F.col("source_row_id") % 11 == 0, None).when(F.col("source_row_id") > 250, "late").otherwise("early"),
        }
    )
    root, store = scratch_path(spark, "versions"), scratch_path(spark, "summaries")
    bounds = {"2026-01-01": (0, 10), "2026-02-01": (10, 200), "2026-03-01": (200, 300)}
    done = []
    for version, (lo, hi) in bounds.items():
        write_version(rows.filter(F.col("source_row_id").between(lo, hi - 1)), root, version)
        assert update_summaries(spark, root, store) == [version]
        done.append(version)
        seen = rows.filter(F.col("source_row_id") < hi)
        _same(fit_summarised(spark.read.option("basePath", root).parquet(root), store, direct_rows=direct_rows), fit_preprocessor(seen))
    assert update_summaries(spark, root, store) == []


def test_an_attempt_that_broke_off_does_not_count(spark, clean_frame):
    store = scratch_path(spark, "summaries")
    spark.range(0).selectExpr("'x' as feature", "'y' as value", "id as n").write.parquet(f"{store}/categories/version=2026-01-01")
    summarise(clean_frame, store, "2026-02-01")
    assert {r["version"] for r in read_categories(spark, store).select("version").distinct().collect()} == {"2026-02-01"}
    summarise(clean_frame, store, "2026-01-01")
    assert read_categories(spark, store).select("version").distinct().count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        summarise(clean_frame, store, "2026-01-01")
    assert os.path.isdir(f"{store}/numbers/version=2026-01-01")


def test_no_rows_to_fit(spark, clean_frame):
    store = scratch_path(spark, "summaries")
    summarise(clean_frame.limit(0), store, "2026-01-01")
    with pytest.raises(ValueError, match="no summarised rows"):
        fit_summarised(clean_frame, store)
