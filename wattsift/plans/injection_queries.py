"""Queries over context means, tails, targets and the five kinds of injected anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattsift.operators.inject import (
    audit_counts,
    audit_ids,
    audit_labelled,
    context_means,
    context_of,
    ratio_tails,
    recompute_derived,
    target_types,
    unchanged_anomalies,
)
from wattsift.plans.catalog import query
from wattsift.plans.energy_view import table
from wattsift.plans.oracle_parts import ADJUSTED, CLEAN, INJECT, KEPT, MEANS, P, TAILS, TARGETS, rounded
from wattsift.plans.shared import clean_energy, labelled_energy, r6
from wattsift.profile import DEFAULT_WEIGHTS


@query(
    "context_means",
    f"with {CLEAN}, {MEANS} select ctx as context, cast(usable_rows as bigint) as usable_rows, pos as source, round(mean, 6) as mean from ctx_means",
)
def context_mean_rows(spark, sf_dir):
    means = context_means(clean_energy(spark, sf_dir))
    return means.select("context", "usable_rows", F.posexplode("means").alias("source", "mean")).select(
        "context", "usable_rows", "source", r6("mean")
    )


@query(
    "rarest_source_order",
    f"with {CLEAN}, {MEANS} select ctx as context, cast(nth - 1 as integer) as place, pos as source from ctx_order",
)
def rarest_source_order(spark, sf_dir):
    means = context_means(clean_energy(spark, sf_dir))
    return means.select("context", F.posexplode("source_order").alias("place", "source"))


@query("ratio_tails", f"with {CLEAN}, {MEANS}, {TAILS} select source_row_id, round({ADJUSTED}, 6) as ratio from tails join clean using (source_row_id)")
def ratio_tail_rows(spark, sf_dir):
    clean = clean_energy(spark, sf_dir)
    return clean.filter(ratio_tails(clean)).select("source_row_id", r6("ratio", ADJUSTED))


@query("target_types", f"with {CLEAN}, {MEANS}, {TARGETS} select source_row_id, ctx as context, anomaly_type from targets")
def target_type_rows(spark, sf_dir):
    clean = clean_energy(spark, sf_dir)
    eligible = F.col(P.shares_valid) & F.col(P.splits_valid)
    kind, _ = target_types(clean, 0.05, 42, DEFAULT_WEIGHTS, eligible)
    return clean.select("source_row_id", context_of().alias("context"), kind.alias("anomaly_type")).filter("anomaly_type is not null")


_CHANGED = (*P.ratios, *P.splits, *P.shares, P.delta, P.shares_sum, P.splits_sum)
_FULL = ("source_row_id", *KEPT, *P.counts, P.mono_flag, "anomaly_type", "is_anomaly", "anomaly_severity", P.shares_valid, P.splits_valid)


def _of_type(kind: str, columns: tuple[str, ...]):
    sql = f"with {INJECT} select source_row_id, anomaly_severity, {rounded(columns)} from labelled where anomaly_type = '{kind}'"

    @query(f"inject_{kind}", sql)
    def run(spark, sf_dir):
        rows = labelled_energy(spark, sf_dir).filter(F.col("anomaly_type") == kind)
        return rows.select("source_row_id", "anomaly_severity", *[r6(c) for c in columns])

    return run


_of_type("contextual", (*P.ratios, P.delta))
_of_type("correlational", (*P.shares, P.shares_sum))
_of_type("structural", (*P.splits, P.splits_sum))
_of_type("energy_mix", (*P.shares, P.shares_sum))
_of_type("combination", _CHANGED)


@query("inject_all", f"with {INJECT} select {', '.join(_FULL)}, {rounded(_CHANGED)} from labelled")
def inject_all(spark, sf_dir):
    return labelled_energy(spark, sf_dir).select(*_FULL, *[r6(c) for c in _CHANGED])


@query(
    "inject_audit",
    f"""with {INJECT} select count(*) as "rows", count(*) filter (where is_anomaly) as anomalies,
 cast(0 as bigint) as broken from labelled""",
)
def inject_audit(spark, sf_dir):
    """All rules summed: a sound labelled set has none broken."""
    report = audit_labelled(labelled_energy(spark, sf_dir), clean_energy(spark, sf_dir))
    broken = [F.col(c) for c in report.columns if c.startswith("bad_")]
    total = broken[0]
    for c in broken[1:]:
        total = total + c
    return report.select("rows", "anomalies", total.alias("broken"))


_SPOILED = f"""spoiled as (select * replace (case when {P.occupation} = '2' then {P.shares_sum} + 1 else {P.shares_sum} end as {P.shares_sum},
 case when {P.year} = '2021' then 'unknown' else 'energy_mix' end as anomaly_type) from
 (select *, not ({P.shares_valid} and {P.splits_valid}) as is_anomaly, 'none' as anomaly_type from clean) t)"""


@query(
    "audit_counts",
    f"""with {CLEAN}, {_SPOILED} select count(*) as "rows", count(*) filter (where is_anomaly) as anomalies,
 count(*) filter (where is_anomaly and anomaly_type = 'unknown') as bad_anomaly_type,
 count(*) filter (where not is_anomaly) as bad_clean_type,
 count(*) filter (where is_anomaly and not {P.shares_valid}) as bad_mix,
 count(*) filter (where is_anomaly and not {P.splits_valid}) as bad_split,
 count(*) filter (where {P.occupation} = '2') as bad_sum from spoiled""",
)
def audit_count_rows(spark, sf_dir):
    """A deliberately spoiled set: the audit must find each kind of fault."""
    clean = clean_energy(spark, sf_dir)
    spoiled = clean.withColumns(
        {
            "is_anomaly": ~(F.col(P.shares_valid) & F.col(P.splits_valid)),
            "anomaly_type": F.when(F.col(P.year) == "2021", "unknown").otherwise("energy_mix"),
            P.shares_sum: F.when(F.col(P.occupation) == "2", F.col(P.shares_sum) + 1).otherwise(F.col(P.shares_sum)),
        }
    )
    return audit_counts(spoiled).select(
        "rows", "anomalies", "bad_anomaly_type", "bad_clean_type", "bad_mix", "bad_split",
        F.col(f"bad_{P.shares_sum}").alias("bad_sum"),
    )


@query(
    "audit_ids",
    """with a as (select l_orderkey as id, count(*) as n from lineitem group by 1), b as (select o_orderkey as id from orders where o_orderstatus <> 'P')
 select (select count(*) from a where n > 1) as bad_duplicate_id,
 (select count(*) from a full join b using (id) where a.n is null or b.id is null) as bad_provenance""",
)
def audit_id_rows(spark, sf_dir):
    """Line keys against order keys: duplicates and ids on one side only are counted in one shuffle."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("id"))
    return audit_ids(lines, orders, "id")


@query(
    "unchanged_anomalies",
    f"""with {CLEAN} select source_row_id from clean where {P.mono_flag} and coalesce({ADJUSTED}, -1) <= 2500""",
)
def unchanged_rows(spark, sf_dir):
    """Rows marked as anomalies but altered only above a ratio: the unaltered ones are reported."""
    clean = clean_energy(spark, sf_dir)
    marked = clean.withColumns(
        {"is_anomaly": F.col(P.mono_flag), ADJUSTED: F.when(F.col(ADJUSTED) > 2500, F.col(ADJUSTED) + 1).otherwise(F.col(ADJUSTED))}
    )
    return unchanged_anomalies(marked, clean)


@query(
    "recompute_derived",
    f"""with {CLEAN} select source_row_id, {P.shares_valid}, {P.splits_valid}, round({P.delta}, 6) as {P.delta},
 round({P.shares_sum}, 6) as {P.shares_sum}, round({P.splits_sum}, 6) as {P.splits_sum} from clean""",
)
def recompute_rows(spark, sf_dir):
    stripped = clean_energy(spark, sf_dir).drop(*P.derived)
    return recompute_derived(stripped).select(
        "source_row_id", P.shares_valid, P.splits_valid, r6(P.delta), r6(P.shares_sum), r6(P.splits_sum)
    )
