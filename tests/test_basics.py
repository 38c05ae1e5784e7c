"""Cleaning, parsing, sampling, allocation, order statistics, CSV."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattsift.functions.keys import natural_id, version_from_timestamp, version_of
from wattsift.functions.numbers import parse_number
from wattsift.functions.shares import ascending_with_top_last, first_open_source, rescale_to_hundred, sums_to_hundred, usable_composition
from wattsift.operators.clean import add_engineered, add_occupation, clean_table, drop_pooled_years, select_features
from wattsift.operators.order_stats import boundaries, exact_quantiles, values_at_ranks
from wattsift.operators.sample import allocate_counts, sample_exact, split_evaluation, weights_from_form
from wattsift.profile import DEFAULT_WEIGHTS, ENERGY
from wattsift.session import scratch_path
from wattsift.sources.csv_locale import assign_row_ids, scan_locale_csv


def test_engineered_features(clean_frame):
    row = add_engineered(add_occupation(clean_frame)).first()
    assert row[ENERGY.delta] == 10.0
    assert row[ENERGY.shares_sum] == 100.0
    assert row[ENERGY.splits_sum] == 100.0


def test_feature_contract_names_what_is_missing(clean_frame):
    with pytest.raises(ValueError, match="electricite_pct"):
        select_features(clean_frame.drop("electricite_pct"))
    assert len(select_features(clean_frame).columns) == 24


def test_rows_without_year_stay(spark):
    rows = spark.createDataFrame([(1, "2010-2019"), (2, None), (3, "2021")], f"id int, {ENERGY.year} string")
    assert sorted(r["id"] for r in drop_pooled_years(rows).collect()) == [2, 3]


def test_clean_table_keeps_unreadable_as_null(spark):
    row = spark.createDataFrame(
        [("2021", "1A", "n/c", "12.5")], f"{ENERGY.year} string, {ENERGY.occupation} string, {ENERGY.ratios[0]} string, {ENERGY.ratios[1]} string"
    )
    for c in ENERGY.splits + ENERGY.shares:
        row = row.withColumn(c[:-4] + "_%", F.lit(100.0 if c in (ENERGY.splits[0], ENERGY.shares[3]) else None).cast("double"))
    out = clean_table(row).first()
    assert out[ENERGY.ratios[0]] is None and out[ENERGY.ratios[1]] == 12.5
    assert out[ENERGY.delta] is None and out[ENERGY.shares_valid] and out[ENERGY.splits_valid]
    assert out[ENERGY.mono_flag] is True


def test_number_text(spark):
    texts = ["1.5", " 1.5 ", "1,5", "1e3", "1.5d", "0x1p3", "1_000", "inf", "", "n/c", None, "-.5", "+7."]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r["v"] for r in rows.select("i", parse_number(F.col("t")).alias("v")).orderBy("i").collect()]
    assert found == [1.5, 1.5, None, 1000.0, None, None, None, math.inf, None, None, None, -0.5, 7.0]


def test_two_tolerances_differ(spark):
    rows = spark.createDataFrame([(99.9,), (100.1,), (100.1005,), (100.2,), (None,), (-1.0,)], "a double").withColumn("b", F.lit(0.0))
    columns = [F.col("a"), F.col("b")]
    found = rows.select(sums_to_hundred(columns).alias("flag"), usable_composition(columns).alias("usable")).collect()
    assert [r["flag"] for r in found] == [True, True, False, False, False, False]
    assert [r["usable"] for r in found] == [True, True, True, False, False, False]


def test_share_arrays(spark):
    one = spark.range(1)
    values = lambda *v: F.array(*[F.lit(x).cast("double") for x in v])
    assert one.select(rescale_to_hundred(values(30, None, -5, 30))).first()[0] == [50.0, 0.0, 0.0, 50.0]
    assert one.select(rescale_to_hundred(values(0, None, -5))).first()[0] == [100.0, 0.0, 0.0]
    assert one.select(ascending_with_top_last(values(5, 9, 5, 9, 1))).first()[0] == [4, 0, 2, 3, 1]
    order = F.array(F.lit(2), F.lit(0), F.lit(1))
    assert one.select(first_open_source(order, values(0, 0, 100))).first()[0] == 0
    assert one.select(first_open_source(order, values(0, 50, 50))).first()[0] == 2
    assert one.select(first_open_source(order, values(None, 0, 100))).first()[0] == 2


def test_versions(spark):
    key = spark.createDataFrame([("raw/x/version=2026-08-31/source.csv", "2026-08-31T10:00:00Z")], "k string, t string")
    assert key.select(version_of(F.col("k")), version_from_timestamp(F.col("t"))).first()[:] == ("2026-08-31", "2026-08-31")
    with pytest.raises(Exception, match="No dataset version"):
        key.select(version_of(F.lit("raw/x/source.csv"))).collect()
    assert len(key.select(natural_id(F.col("k"))).first()[0]) == 36


def test_allocation():
    assert allocate_counts(20, DEFAULT_WEIGHTS) == {"contextual": 4, "correlational": 5, "structural": 4, "energy_mix": 5, "combination": 2}
    assert allocate_counts(4, DEFAULT_WEIGHTS) == {"contextual": 1, "correlational": 1, "structural": 1, "energy_mix": 1, "combination": 0}
    with pytest.raises(ValueError, match="Unsupported anomaly types"):
        allocate_counts(20, {"contextual_weight": 1.0})
    for bad in ({"contextual": 0.5}, {"contextual": 1.5, "structural": -0.5}, {}, {"contextual": math.nan}):
        with pytest.raises(ValueError, match="add up to 1"):
            allocate_counts(20, bad)


def test_weights_from_form():
    form = {f"{k}_weight": str(v) for k, v in DEFAULT_WEIGHTS.items()}
    assert weights_from_form(form) == DEFAULT_WEIGHTS
    with pytest.raises(ValueError, match="not to 1"):
        weights_from_form(form | {"contextual_weight": "0.3"})


@pytest.mark.parametrize("direct_rows", [7, 1_000_000])
def test_order_statistics_with_hot_value(spark, direct_rows):
    rng = np.random.default_rng(3)
    values = [float(v) for v in np.concatenate([rng.normal(size=300), np.full(200, 0.25), rng.integers(0, 5, 100)])]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(1000, None)], "id long, v double").repartition(5)
    ordered = sorted(values)
    ranks = [1, 2, 150, 300, 301, 450, 599, 600]
    hits = values_at_ranks(df, {"v": F.col("v")}, {"v": ranks}, direct_rows=direct_rows)
    for r in ranks:
        hit = hits[("v", r)]
        assert hit.value == ordered[r - 1]
        assert hit.below == sum(x < hit.value for x in ordered) and hit.ties == ordered.count(hit.value)
    quantiles = exact_quantiles(df, {"v": F.col("v")}, [0.05, 0.5, 0.95], direct_rows)["v"]
    assert quantiles == pytest.approx(list(np.quantile(values, [0.05, 0.5, 0.95])))
    by_key = sorted((v, i) for i, v in enumerate(values))
    for r, edge in zip(ranks, boundaries(df, F.col("v"), F.col("id"), ranks, direct_rows=direct_rows), strict=True):
        got = {x["id"] for x in df.filter(edge.covers(F.col("v"), F.col("id"))).collect()}
        assert got == {i for _, i in by_key[:r]}
    with pytest.raises(ValueError, match="rank must be between"):
        values_at_ranks(df, {"v": F.col("v")}, {"v": [601]})


def test_sample_does_not_depend_on_partitions(spark):
    rows = spark.range(5000).withColumnRenamed("id", "source_row_id")
    picked = [
        sorted(r[0] for r in sample_exact(rows.repartition(n), 300, direct_rows=d).collect()) for n, d in ((1, 10**6), (7, 20))
    ]
    assert picked[0] == picked[1] and len(picked[0]) == 300
    assert sample_exact(rows, 9000).count() == 5000
    gone = rows.filter("source_row_id < 4900")
    assert sorted(r[0] for r in sample_exact(rows, 1000, exclude=gone).collect()) == list(range(4900, 5000))


def test_split_sizes(spark):
    rows = spark.range(1001).select(F.col("id").alias("source_row_id"), (F.col("id") < 101).alias("is_anomaly"))
    validation, test = split_evaluation(rows, 0.5)
    assert validation.groupBy("is_anomaly").count().collect() and validation.filter("is_anomaly").count() == round(101 * 0.5)
    assert validation.count() + test.count() == 1001 and validation.join(test, "source_row_id").count() == 0
    with pytest.raises(ValueError):
        split_evaluation(rows, 1.0)


def test_locale_csv(spark):
    path = scratch_path(spark, "csv-test")
    lines = spark.createDataFrame([("value;note;n",), ("1,5;a;1",), ("2,5;NA;2",)], "value string").coalesce(1)
    lines.write.text(path)
    found = scan_locale_csv(spark, path, row_id="source_row_id").orderBy("source_row_id").collect()
    assert [tuple(r) for r in found] == [(0, 1.5, "a", 1), (1, 2.5, None, 2)]
    assert scan_locale_csv(spark, path).schema.simpleString() == "struct<value:double,note:string,n:bigint>"
    with pytest.raises(ValueError, match="already exists"):
        scan_locale_csv(spark, path, row_id="value")


def test_row_ids_over_many_splits(spark):
    path = scratch_path(spark, "csv-splits")
    spark.range(60000).select(F.col("id").alias("original"), F.lit("x" * 40).alias("pad")).repartitionByRange(3, "original").sortWithinPartitions(
        "original"
    ).write.option("header", True).option("sep", ";").csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = scan_locale_csv(spark, path, types={"original": "long"}, row_id="source_row_id")
        assert found.rdd.getNumPartitions() > 8
        assert found.filter("source_row_id <> original").count() == 0 and found.count() == 60000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    ids = assign_row_ids(spark.range(1000).repartition(7)).agg(F.min("source_row_id"), F.max("source_row_id"), F.count_distinct("source_row_id"))
    assert tuple(ids.first()) == (0, 999, 1000)
