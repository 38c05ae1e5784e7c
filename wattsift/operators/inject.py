"""Labelled anomalies injected into a clean table.

Which rows become anomalies, and of which type, is decided row by row against a handful of boundary
keys.  Rows that stay clean pass straight through; only the targets (a few percent) are shuffled to
meet their donor values.  Every donor value is read from the clean table, so the result does not
depend on the order of work.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattsift.functions.keys import draw, group_key
from wattsift.functions.shares import (
    all_on,
    ascending_with_top_last,
    first_open_source,
    rescale_to_hundred,
    usable_composition,
)
from wattsift.operators.clean import recompute_derived, require_columns
from wattsift.operators.donors import match_donors, small
from wattsift.operators.order_stats import DIRECT_ROWS, Boundary, boundaries
from wattsift.operators.sample import allocate_counts
from wattsift.profile import ANOMALY_TYPES, DEFAULT_WEIGHTS, ENERGY, LABEL_COLUMNS, SEVERITY, Profile
from wattsift.session import materialise
from wattsift.sources.csv_locale import assign_row_ids

TAIL, MIX, MONO, MULTI = "tail", "mix", "mono", "multi"


def _array(columns: tuple[str, ...]) -> Column:
    return F.array(*[F.col(c) for c in columns])


def context_of(profile: Profile = ENERGY) -> Column:
    return group_key([F.col(c) for c in profile.context])


def usable_mix(profile: Profile = ENERGY) -> Column:
    return usable_composition([F.col(c) for c in profile.shares])


def usable_split(profile: Profile = ENERGY) -> Column:
    return usable_composition([F.col(c) for c in profile.splits])


def severity_of(kind: Column) -> Column:
    result = F.lit("none")
    for name, level in SEVERITY.items():
        result = F.when(kind == name, F.lit(level)).otherwise(result)
    return result


def has_ratios(profile: Profile = ENERGY) -> Column:
    return F.col(profile.ratios[0]).isNotNull() & F.col(profile.ratios[1]).isNotNull()


def ratio_tails(df: DataFrame, profile: Profile = ENERGY, direct_rows: int = DIRECT_ROWS) -> Column:
    """Predicate for the lowest and highest tenth by adjusted ratio, in the order (ratio, id)."""
    value = F.when(has_ratios(profile), F.col(profile.ratios[0]))
    rid = F.col(profile.row_id)
    rows = df.agg(F.count(value)).first()[0]
    if not rows:
        return F.lit(False)
    tail = max(1, rows // 10)
    low, high = boundaries(df, value, rid, [tail, max(0, rows - tail)], rows, direct_rows=direct_rows)
    return F.coalesce(low.covers(value, rid) | (value.isNotNull() & ~high.covers(value, rid)), F.lit(False))


def context_means(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """(context, means, source_order): mean share of every source per context over usable rows.

    Contexts without a usable row take the means over all usable rows.  Source order is ascending, the
    dominant source last.
    """
    usable = usable_mix(profile)
    grouped = df.groupBy(context_of(profile).alias("context")).agg(
        F.array(*[F.avg(F.when(usable, F.col(c))) for c in profile.shares]).alias("own"),
        F.count_if(usable).alias("usable_rows"),
    )
    overall = df.agg(*[F.avg(F.when(usable, F.col(c))) for c in profile.shares]).first()
    fallback = F.array(*[F.lit(x).cast("double") for x in overall])
    means = F.when(F.col("usable_rows") > 0, F.col("own")).otherwise(fallback)
    return grouped.select("context", "usable_rows", means.alias("means")).withColumn(
        "source_order", ascending_with_top_last(F.col("means"))
    )


def target_types(
    df: DataFrame,
    anomaly_rate: float,
    seed: int,
    weights: Mapping[str, float],
    eligible: Column | None = None,
    profile: Profile = ENERGY,
    direct_rows: int = DIRECT_ROWS,
) -> tuple[Column, int]:
    """(type expression, number of targets): round(rate * rows) rows in draw order, cut by type counts."""
    rid = F.col(profile.row_id)
    able = F.lit(True) if eligible is None else eligible
    total, choosable = df.agg(F.count(F.lit(1)), F.count_if(able)).first()
    wanted = round(total * anomaly_rate)
    if wanted > choosable:
        raise ValueError(f"{wanted} anomalies wanted but only {choosable} rows can become one.")
    ends, upto = {}, 0
    for name, count in allocate_counts(wanted, weights).items():
        upto += count
        ends[name] = upto
    key = draw(seed, "target", rid)
    found = boundaries(
        df.filter(able), key, rid, list(ends.values()), choosable, uniform_draw=True, direct_rows=direct_rows
    )
    edges: dict[str, Boundary] = dict(zip(ends, found, strict=True))
    kind = F.lit(None).cast("string")
    for name, edge in reversed(edges.items()):
        kind = F.when(edge.covers(key, rid), F.lit(name)).otherwise(kind)
    # the last edge covers all targets: the other rows, most of the table, are settled by one comparison
    return F.when(able & found[-1].covers(key, rid), kind), wanted


def _memberships(df: DataFrame, id_name: str, values_name: str, entries: list[tuple[Column, Column, Column]], profile: Profile) -> DataFrame:
    """Long form (pool, context, id, values): one row per pool an input row belongs to."""
    cells = F.array(*[F.struct(test.alias("member"), pool.alias("pool"), values.alias("values")) for test, pool, values in entries])
    members = F.filter(cells, lambda c: c["member"])
    return df.select(
        context_of(profile).alias("context"), F.col(profile.row_id).alias(id_name), F.explode(members).alias("m")
    ).select(F.col("m.pool").alias("pool"), "context", id_name, F.col("m.values").alias(values_name))


def donor_pool(df: DataFrame, in_tails: Column, profile: Profile = ENERGY) -> DataFrame:
    """Tail rows give ratios, usable mixes give shares, usable splits give splits within their class."""
    mono = F.coalesce(F.col(profile.mono_flag), F.lit(False))
    entries = [
        (in_tails, F.lit(TAIL), _array(profile.ratios)),
        (usable_mix(profile), F.lit(MIX), _array(profile.shares)),
        (usable_split(profile), F.when(mono, F.lit(MONO)).otherwise(F.lit(MULTI)), _array(profile.splits)),
    ]
    return _memberships(df, "donor_id", "donor_values", entries, profile)


def donor_targets(targets: DataFrame, kind: Column, profile: Profile = ENERGY) -> DataFrame:
    mono = F.coalesce(F.col(profile.mono_flag), F.lit(False))
    entries = [
        (kind.isin("contextual", "combination"), F.lit(TAIL), _array(profile.ratios)),
        (kind.isin("correlational"), F.lit(MIX), _array(profile.shares)),
        (
            kind.isin("structural", "combination"),
            F.when(mono, F.lit(MONO)).otherwise(F.lit(MULTI)),
            _array(profile.splits),
        ),
    ]
    return _memberships(targets, "target_id", "target_values", entries, profile)


def _needed(kind: Column) -> Column:
    """Number of donors a target of this type must have."""
    return F.when(kind == "combination", 2).when(kind == "energy_mix", 0).otherwise(1)


def inject_anomalies(
    clean: DataFrame,
    anomaly_rate: float = 0.05,
    seed: int = 42,
    weights: Mapping[str, float] | None = None,
    eligible_only: bool = False,
    audit: bool = True,
    profile: Profile = ENERGY,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """The clean table with round(rate * rows) rows altered and labelled.

    Targets are drawn from all rows; a row whose own untouched composition is invalid then fails the
    audit.  ``eligible_only`` draws from rows valid in both compositions instead.
    """
    if not 0 <= anomaly_rate <= 1:
        raise ValueError(f"anomaly_rate is the share of rows to change, from 0 to 1: {anomaly_rate}")
    needed = {*profile.shares, *profile.splits, *profile.ratios, profile.mono_flag, *profile.context}
    require_columns(clean, needed, "columns needed to inject are absent")
    if profile.row_id not in clean.columns:
        clean = materialise(assign_row_ids(clean, profile.row_id), "clean-with-ids")
    if anomaly_rate and clean.limit(2).count() < 2:
        raise ValueError("a table of fewer than two rows has no donors")
    weights = DEFAULT_WEIGHTS if weights is None else weights

    eligible = None
    if eligible_only:
        flags = {profile.shares_valid, profile.splits_valid}
        if not flags <= set(clean.columns):
            clean = recompute_derived(clean, profile)
        eligible = F.col(profile.shares_valid) & F.col(profile.splits_valid)
    kind, wanted = target_types(clean, anomaly_rate, seed, weights, eligible, profile, direct_rows)
    untouched = clean.withColumn("anomaly_type", F.lit("none")).filter(kind.isNull())
    if not wanted:
        return _labelled(untouched, profile)

    targets = materialise(clean.withColumn("anomaly_type", kind).filter("anomaly_type is not null"), "targets")
    in_tails = ratio_tails(clean, profile, direct_rows)
    donors = match_donors(
        donor_targets(targets, F.col("anomaly_type"), profile), donor_pool(clean, in_tails, profile), seed
    )
    patches = donors.groupBy(F.col("target_id").alias(profile.row_id)).agg(
        F.count(F.lit(1)).alias("__donors"),
        F.first(F.when(F.col("pool") == TAIL, F.col("donor_values")), True).alias("__ratios"),
        F.first(F.when(F.col("pool") == MIX, F.col("donor_values")), True).alias("__shares"),
        F.first(F.when(F.col("pool").isin(MONO, MULTI), F.col("donor_values")), True).alias("__splits"),
    )
    means = context_means(clean, profile).select(F.col("context").alias("__context"), "source_order")
    n_contexts = means.count()
    patched = (
        targets.join(patches, profile.row_id, "left")
        .withColumn("__context", context_of(profile))
        .join(small(means, n_contexts), "__context")
        .transform(_apply_patches, profile)
    )
    altered = _labelled(patched, profile).select(_labelled(untouched, profile).columns)
    result = materialise(_labelled(untouched, profile).unionByName(altered), "labelled")
    if audit:
        audit_labelled(result, clean, profile, strict=True)
    return result


def _apply_patches(df: DataFrame, profile: Profile) -> DataFrame:
    kind, rid = F.col("anomaly_type"), F.col(profile.row_id)
    short = F.coalesce(F.col("__donors"), F.lit(0)) < _needed(kind)
    complaint = F.raise_error(F.concat(F.lit("no donor differs enough for row "), rid.cast("string")))
    df = df.withColumn("anomaly_type", F.when(short, complaint.cast("string")).otherwise(kind))
    shares = _array(profile.shares)
    concentrated = all_on(first_open_source(F.col("source_order"), shares), len(profile.shares))
    df = df.withColumns(
        {
            "__new_shares": F.when(kind.isin("energy_mix", "combination"), concentrated).when(
                kind == "correlational", rescale_to_hundred(F.col("__shares"))
            ),
            "__new_splits": F.when(kind.isin("structural", "combination"), rescale_to_hundred(F.col("__splits"))),
            "__new_ratios": F.when(kind.isin("contextual", "combination"), F.col("__ratios")),
        }
    )
    updates = {}
    for patch, columns in (("__new_ratios", profile.ratios), ("__new_shares", profile.shares), ("__new_splits", profile.splits)):
        for i, c in enumerate(columns):
            updates[c] = F.when(F.col(patch).isNotNull(), F.col(patch)[i]).otherwise(F.col(c))
    return df.withColumns(updates)


def _labelled(df: DataFrame, profile: Profile) -> DataFrame:
    labelled = df.withColumns(
        {"is_anomaly": F.col("anomaly_type") != "none", "anomaly_severity": severity_of(F.col("anomaly_type"))}
    )
    hidden = [c for c in labelled.columns if c.startswith("__") or c == "source_order"]
    rest = [c for c in labelled.columns if c not in hidden and c not in LABEL_COLUMNS]
    return recompute_derived(labelled.select(*rest, *LABEL_COLUMNS), profile)


# ---- audit ----


def audit_counts(labelled: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """Row-local rules in one aggregate; every ``bad_*`` column should be 0."""
    flag = F.col("is_anomaly").cast("boolean")
    was = {c: F.col(c) for c in profile.derived}
    fresh = recompute_derived(labelled.withColumns({f"__{c}": v for c, v in was.items()}), profile)
    checks = {
        "rows": F.count(F.lit(1)),
        "anomalies": F.count_if(flag),
        "bad_missing_id": F.count_if(F.col(profile.row_id).isNull()),
        "bad_anomaly_type": F.count_if(flag & ~F.coalesce(F.col("anomaly_type").isin(*ANOMALY_TYPES), F.lit(False))),
        "bad_clean_type": F.count_if(~flag & ~F.col("anomaly_type").eqNullSafe("none")),
        "bad_mix": F.count_if(flag & ~F.col(f"__{profile.shares_valid}")),
        "bad_split": F.count_if(flag & ~F.col(f"__{profile.splits_valid}")),
    }
    for c in profile.derived:
        checks[f"bad_{c}"] = F.count_if(~F.col(f"__{c}").eqNullSafe(F.col(c)))
    return fresh.agg(*[v.alias(k) for k, v in checks.items()])


def audit_ids(labelled: DataFrame, clean: DataFrame, row_id: str) -> DataFrame:
    """Uniqueness and equality of both id sets from one shuffle of ids."""
    sides = labelled.select(row_id, F.lit(1).alias("here"), F.lit(0).alias("there")).unionByName(
        clean.select(row_id, F.lit(0).alias("here"), F.lit(1).alias("there"))
    )
    return (
        sides.groupBy(row_id)
        .agg(F.sum("here").alias("here"), F.sum("there").alias("there"))
        .agg(
            F.count_if(F.col("here") > 1).alias("bad_duplicate_id"),
            F.count_if((F.col("here") > 0) != (F.col("there") > 0)).alias("bad_provenance"),
        )
    )


def unchanged_anomalies(labelled: DataFrame, clean: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """Ids of anomalies equal to their clean row in every column; null equals null."""
    compared = [c for c in clean.columns if c not in {*LABEL_COLUMNS, profile.row_id}]
    mutated = labelled.filter(F.col("is_anomaly")).select(profile.row_id, F.struct(*compared).alias("after"))
    original = clean.select(profile.row_id, F.struct(*compared).alias("before"))
    return mutated.join(original, profile.row_id).filter(F.col("after").eqNullSafe(F.col("before"))).select(profile.row_id)


def audit_labelled(
    labelled: DataFrame, clean: DataFrame | None = None, profile: Profile = ENERGY, strict: bool = False
) -> DataFrame:
    """One-row report of all rules; ``strict`` raises on the first broken one."""
    needed = {*LABEL_COLUMNS, profile.row_id, *profile.shares, *profile.splits, *profile.ratios, *profile.derived}
    require_columns(labelled, needed, "columns needed to audit are absent")
    report = audit_counts(labelled, profile).first().asDict()
    if clean is not None:
        report |= audit_ids(labelled, clean, profile.row_id).first().asDict()
        report["bad_unchanged"] = unchanged_anomalies(labelled, clean, profile).count()
    else:
        own = labelled.groupBy(profile.row_id).count().filter("count > 1")
        report["bad_duplicate_id"] = own.count()
    if strict:
        broken = {k: v for k, v in report.items() if k.startswith("bad_") and v}
        if broken:
            raise ValueError(f"Labelled dataset breaks its rules: {broken}")
    schema = ", ".join(f"{k} long" for k in report)
    return labelled.sparkSession.createDataFrame([tuple(report.values())], schema)
