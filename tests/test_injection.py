"""Injection, donors and audit."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tables import CLEAN_SCHEMA, clean_rows

from wattsift.operators.donors import _from_options, match_donors, pool_positions, with_ranges
from wattsift.operators.inject import audit_labelled, inject_anomalies
from wattsift.operators.clean import recompute_derived
from wattsift.profile import ENERGY


def test_small_frame(spark, clean_frame):
    first = inject_anomalies(clean_frame, 0.2, 7)
    second = inject_anomalies(clean_frame.repartition(5), 0.2, 7)
    assert first.exceptAll(second).count() == 0
    assert first.filter("is_anomaly").count() == 4
    kinds = {r["anomaly_type"]: r["count"] for r in first.filter("is_anomaly").groupBy("anomaly_type").count().collect()}
    assert kinds == {"contextual": 1, "correlational": 1, "structural": 1, "energy_mix": 1}
    assert sorted(r[0] for r in first.select("source_row_id").collect()) == list(range(20))
    assert "is_anomaly" not in clean_frame.columns
    mix = first.filter("anomaly_type = 'energy_mix'").first()
    assert sorted(mix[c] for c in ENERGY.shares) == [0.0] * 11 + [100.0]


def test_rate_and_column_guards(clean_frame):
    with pytest.raises(ValueError, match="share of rows"):
        inject_anomalies(clean_frame, 1.5)
    with pytest.raises(ValueError, match="no donors"):
        inject_anomalies(clean_frame.limit(1), 0.5)
    with pytest.raises(ValueError, match="absent"):
        inject_anomalies(clean_frame.drop(ENERGY.shares[2]), 0.5)
    assert inject_anomalies(clean_frame, 0.0).filter("is_anomaly").count() == 0


def test_no_donor_is_an_error(spark):
    rows = [r | {ENERGY.shares[0]: 100.0, ENERGY.shares[1]: 0.0} for r in clean_rows(10)]
    same = spark.createDataFrame(rows, CLEAN_SCHEMA)
    with pytest.raises(Exception, match="no donor"):
        inject_anomalies(same, 0.5, weights={"correlational": 1.0})


def test_invalid_targets_fail_the_audit_unless_left_out(spark):
    rows = [r | ({ENERGY.shares[0]: 10.0} if r["source_row_id"] < 15 else {}) for r in clean_rows(40)]
    frame = spark.createDataFrame(rows, CLEAN_SCHEMA)
    with pytest.raises(ValueError, match="bad_mix"):
        inject_anomalies(frame, 0.5, weights={"contextual": 1.0})
    labelled = inject_anomalies(frame, 0.5, weights={"contextual": 1.0}, eligible_only=True)
    assert labelled.filter("is_anomaly").count() == 20


def test_audit_finds_faults(spark, clean_frame):
    clean = recompute_derived(clean_frame)
    sound = inject_anomalies(clean, 0.2, 7)
    swapped = sound.withColumn("source_row_id", F.when(F.col("source_row_id") == 3, 4).otherwise(F.col("source_row_id")))
    report = audit_labelled(swapped, clean).first()
    assert report["bad_duplicate_id"] == 1 and report["bad_provenance"] == 1
    renamed = sound.withColumn("anomaly_type", F.when(F.col("is_anomaly"), "odd").otherwise("none"))
    assert audit_labelled(renamed).first()["bad_anomaly_type"] == 4
    untouched = clean.withColumns({"is_anomaly": F.lit(True), "anomaly_type": F.lit("structural"), "anomaly_severity": F.lit("medium")})
    assert audit_labelled(untouched, clean).first()["bad_unchanged"] == 20


def _pool(spark, rows):
    return spark.createDataFrame(rows, "pool string, context string, donor_id long, donor_values array<double>")


def test_positions_are_dense_and_independent_of_slices(spark):
    rows = [("p", "hot" if i % 3 else f"c{i % 7}", i, [float(i)]) for i in range(900)]
    small, _ = pool_positions(_pool(spark, rows), 1)
    sliced, ranges = pool_positions(_pool(spark, rows).repartition(6), 1, slice_rows=20)
    a = {r["donor_id"]: r["position"] for r in small.collect()}
    b = {r["donor_id"]: r["position"] for r in sliced.collect()}
    assert a == b and sorted(a.values()) == list(range(900))
    for r in ranges.collect():
        inside = sorted(p["position"] for p in sliced.filter(F.col("context") == r["context"]).collect())
        assert inside == list(range(r["lo"], r["lo"] + r["len"]))


def test_donors_prefer_other_contexts_and_differ(spark):
    pool = _pool(spark, [("p", f"c{i % 3}", i, [float(i % 4)]) for i in range(60)] + [("q", "only", 100 + i, [float(i)]) for i in range(5)])
    targets = spark.createDataFrame(
        [("p", "c0", 0, [0.0]), ("p", "unknown", 900, [2.0]), ("q", "only", 100, [0.0])],
        "pool string, context string, target_id long, target_values array<double>",
    )
    found = {(r["pool"], r["target_id"]): r for r in match_donors(targets, pool, 5).collect()}
    assert len(found) == 3
    assert found[("p", 0)]["donor_id"] % 3 != 0 and found[("p", 0)]["donor_values"] != [0.0]
    assert found[("p", 900)]["donor_values"] != [2.0]
    assert found[("q", 100)]["donor_id"] != 100


def test_rare_donor_is_found_after_all_draws_fail(spark):
    rows = [("p", f"c{i % 2}", i, [1.0]) for i in range(2000)] + [("p", "c0", 5000, [1.0]), ("p", "c1", 5001, [9.0]), ("p", "c0", 5002, [7.0])]
    targets = spark.createDataFrame(
        [("p", "c0", 0, [1.0]), ("p", "c1", 1, [1.0])], "pool string, context string, target_id long, target_values array<double>"
    )
    found = {r["target_id"]: r["donor_id"] for r in match_donors(targets, _pool(spark, rows), 5, first_draws=2, all_draws=3).collect()}
    assert found == {0: 5001, 1: 5002}


def _asked(spark, rows):
    return spark.createDataFrame(rows, "pool string, context string, target_id long, target_values array<double>")


def _close(v, t):
    def same(a, b):
        if a is None or b is None:
            return a is None and b is None
        gap, room = abs(a - b), 1e-8 + 1e-5 * abs(b)
        return room != room or gap <= room  # NaN equals itself and is beyond every number

    return all(same(a, b) for a, b in zip(v, t, strict=True))


@pytest.mark.parametrize("seed", range(3))
def test_every_target_with_a_donor_gets_one(spark, seed):
    rng = random.Random(seed)
    step = [0.0, 6e-6, 1.2e-5, 2.4e-5, 1e-9]
    pick = lambda: rng.choice([None, float("inf"), float("nan"), -2.0, 0.0, 1e-8, *[1.0 + s for s in step], 1e12, 1e12 * (1 + 2e-5)])
    pools = {p: [pick() for _ in range(k)] for p, k in (("a", 1), ("b", 2), ("c", 3), ("d", 2))}
    rows = [(p, rng.choice("xxxxyz"), i, [rng.choice(few) for _ in range(2)]) for i, (p, few) in enumerate((p, f) for _ in range(25) for p, f in pools.items())]
    targets = [(p, c, 1000 + i, v) for i, (p, c, _, v) in enumerate(rows)] + [(p, "new", 2000 + i, v) for i, (p, _, _, v) in enumerate(rows[:20])]
    positions, ranges = pool_positions(_pool(spark, rows), seed)
    asked = with_ranges(_asked(spark, targets), ranges, ranges.count())
    found = {r["target_id"]: r for r in _from_options(asked, positions).collect()}
    by_id = {r[2]: r for r in rows}
    for pool, context, target, values in targets:
        own_only = {r[1] for r in rows if r[0] == pool} == {context}
        fits = [r[2] for r in rows if r[0] == pool and (r[1] != context or own_only) and not _close(r[3], values)]
        assert (target in found) == bool(fits)
        assert target not in found or (found[target]["donor_id"] in fits and found[target]["pool"] == by_id[found[target]["donor_id"]][0])


def test_work_for_rare_donors_does_not_grow_with_their_number(spark):
    def jobs(n):
        rows = [("p", f"c{i % 5}", i, [1.0 + i * 1e-10]) for i in range(n)] + [("p", "c1", n + 1, [1.00003])]
        targets = _asked(spark, [("p", "c0", 0, [1.0]), ("p", "c1", 1, [1.0]), ("p", "c0", 2, [1.00003])])
        spark.sparkContext.setJobGroup(f"donors-{n}", "")
        found = {r["target_id"]: r["donor_id"] for r in match_donors(targets, _pool(spark, rows), 5, first_draws=1, all_draws=2).collect()}
        spark.sparkContext.setJobGroup("rest", "")
        assert found[0] == n + 1 and 1 not in found and 2 in found
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"donors-{n}"))

    assert jobs(10_000) <= jobs(10) + 4


def test_missing_ids_are_supplied(clean_frame):
    labelled = inject_anomalies(clean_frame.drop("source_row_id"), 0.2, 7)
    assert sorted(r[0] for r in labelled.select("source_row_id").collect()) == list(range(20))


def test_most_targets_draw_twice_only(spark, monkeypatch):
    """Further draws are made for the targets that are left; before, every target came with all its first draws."""
    from wattsift.operators import donors

    rows = [("p", f"c{i % 4}", i, [float(i)]) for i in range(40)]
    pool = _pool(spark, rows)
    targets = spark.createDataFrame([("p", f"c{i % 4}", i, [float(i)]) for i in range(12)], "pool string, context string, target_id long, target_values array<double>")
    made, tried = [], donors._try_draws
    monkeypatch.setattr(donors, "_try_draws", lambda t, p, s, attempts, n: made.append(n * len(attempts)) or tried(t, p, s, attempts, n))
    found = match_donors(targets, pool, 3)
    assert found.count() == 12 and sum(made) <= 3 * 12


def test_draws_are_worked_out_once_per_row(spark, monkeypatch):
    """A draw is a digest; a search compares it with many bounds but makes it once."""
    from wattsift.functions.keys import draw
    from wattsift.operators import order_stats

    seen, ranked = [], order_stats._rank_directly

    def spy(df, values, pending, found):
        v = values["v"]
        plan = df.agg(F.count_if((v < 5) | (v == 7)), F.count_if(v > 9))._jdf.queryExecution().optimizedPlan().toString()
        seen.append(plan.count("md5("))
        ranked(df, values, pending, found)

    monkeypatch.setattr(order_stats, "_rank_directly", spy)
    rows = spark.range(50)
    edges = order_stats.boundaries(rows, draw(1, "x", F.col("id")), F.col("id"), [3, 9], 50)
    assert rows.filter(edges[1].covers(draw(1, "x", F.col("id")), F.col("id"))).count() == 9
    assert seen == [1]
