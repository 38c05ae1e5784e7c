"""Queries over score curves, thresholds, rankings and diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattsift.operators.curve import (
    OVERALL,
    as_scores,
    best_f1_threshold,
    curve_metrics,
    hardest_types,
    metrics_long,
    overall_diagnostics,
    pr_points,
    score_curve,
    top_k_metrics,
    top_rate_threshold,
    type_diagnostics,
)
from wattsift.operators.order_stats import exact_quantiles
from wattsift.plans.catalog import query
from wattsift.plans.energy_view import table
from wattsift.plans.shared import SCORES_SQL, order_scores, r6
from wattsift.profile import ANOMALY_TYPES

_LINES_SQL = "select 'model' as model, l_quantity as score, l_returnflag = 'R' as is_anomaly from lineitem"


def _line_scores(spark, sf_dir):
    """Fifty distinct scores over all lines: heavy ties."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", (F.col("l_returnflag") == "R").alias("is_anomaly"))
    return as_scores(lines, score="l_quantity", row_id="l_orderkey")


_CURVE = """hist as (select model, score, count(*) filter (where is_anomaly) as pos, count(*) filter (where not is_anomaly) as neg from s group by model, score),
 curve as (select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg, sum(pos) over (partition by model) as p, sum(neg) over (partition by model) as n
  from hist window w as (partition by model order by score desc))"""


@query(
    "pr_curve",
    f"""with {SCORES_SQL}, s as (select * from scores), {_CURVE} select model, score, cast(cum_pos as bigint) as cum_pos, cast(cum_neg as bigint) as cum_neg,
 round(cum_pos / (cum_pos + cum_neg), 6) as "precision", round(cum_pos / p, 6) as recall from curve""",
)
def pr_curve(spark, sf_dir):
    points = pr_points(score_curve(order_scores(spark, sf_dir), ()))
    return points.select("model", "score", "cum_pos", "cum_neg", r6("precision"), r6("recall"))


@query(
    "pr_curve_bucketed",
    f"""with {SCORES_SQL}, s as (select * from scores), {_CURVE} select model, score, cast(cum_pos as bigint) as cum_pos, cast(cum_neg as bigint) as cum_neg,
 round(cum_pos / (cum_pos + cum_neg), 6) as "precision", round(cum_pos / p, 6) as recall from curve""",
)
def pr_curve_bucketed(spark, sf_dir):
    """The same curve through many score buckets, as a large table would take it."""
    points = pr_points(score_curve(order_scores(spark, sf_dir), (), rows_per_bucket=1000))
    return points.select("model", "score", "cum_pos", "cum_neg", r6("precision"), r6("recall"))


_AP = "round(sum(pos * cum_pos / (cum_pos + cum_neg)) / max(p), 6) as pr_auc"
_AUC = "round(sum(neg * (cum_pos - pos / 2)) / (cast(max(p) as double) * max(n)), 6) as roc_auc"


@query("avg_precision", f"with s as ({_LINES_SQL}), {_CURVE} select model, {_AP} from curve group by model")
def avg_precision(spark, sf_dir):
    return curve_metrics(score_curve(_line_scores(spark, sf_dir), ()), ()).select("model", r6("pr_auc"))


@query("roc_auc", f"with s as ({_LINES_SQL}), {_CURVE} select model, {_AUC} from curve group by model")
def roc_auc(spark, sf_dir):
    return curve_metrics(score_curve(_line_scores(spark, sf_dir), ()), ()).select("model", r6("roc_auc"))


_F1 = "2 * cum_pos / (cum_pos + cum_neg + p)"


@query(
    "best_f1_threshold",
    f"""with {SCORES_SQL}, s as (select * from scores), {_CURVE} select model, score as threshold from (select *, row_number() over (partition by model order by {_F1} desc, score) as rn
 from curve) t where rn = 1""",
)
def best_f1(spark, sf_dir):
    return best_f1_threshold(score_curve(order_scores(spark, sf_dir), ()))


@query(
    "top_rate_threshold",
    f"""with {SCORES_SQL} select model, score as threshold from (select *, row_number() over (partition by model order by score desc) as rn,
 greatest(1, round_even(count(*) over (partition by model) * 0.05, 0)) as k from scores) t where rn = k""",
)
def top_rate(spark, sf_dir):
    found = top_rate_threshold(order_scores(spark, sf_dir), 0.05)
    return spark.createDataFrame(list(found.items()), "model string, threshold double")


_KS = (10, 100, 1000)
_AT_K = " union all ".join(
    f"""select model, cast({k} as bigint) as k, count(*) filter (where rn <= {k} and is_anomaly) as hits, count(*) filter (where is_anomaly) as p
 from (select *, row_number() over (partition by model order by score desc, source_row_id) as rn from scores) t group by model"""
    for k in _KS
)


@query("precision_at_k", f"with {SCORES_SQL}, h as ({_AT_K}) select model, k, round(hits / k, 6) as precision_at_k from h")
def precision_at_k(spark, sf_dir):
    return top_k_metrics(order_scores(spark, sf_dir), _KS).select("model", "k", r6("precision_at_k"))


@query("recall_at_k", f"with {SCORES_SQL}, h as ({_AT_K}) select model, k, round(hits / p, 6) as recall_at_k from h")
def recall_at_k(spark, sf_dir):
    return top_k_metrics(order_scores(spark, sf_dir), _KS).select("model", "k", r6("recall_at_k"))


_TYPE_TOP = " union all ".join(
    f"""select model, '{t}' as anomaly_type, cast({k} as bigint) as k, round(count(*) filter (where rn <= {k} and is_anomaly) / {k}, 6) as precision_at_k,
 round(count(*) filter (where rn <= {k} and is_anomaly) / count(*) filter (where is_anomaly), 6) as recall_at_k
 from (select *, row_number() over (partition by model order by score desc, source_row_id) as rn from scores where {"true" if t == OVERALL else f"not is_anomaly or anomaly_type = '{t}'"}) t group by model"""
    for t in (OVERALL, *ANOMALY_TYPES)
    for k in (50, 500)
)


@query("top_k_by_type", f"with {SCORES_SQL} {_TYPE_TOP}")
def top_k_by_type(spark, sf_dir):
    found = top_k_metrics(order_scores(spark, sf_dir), (50, 500), ANOMALY_TYPES)
    return found.select("model", "anomaly_type", "k", r6("precision_at_k"), r6("recall_at_k"))


KINDS = f"""subsets as (select '{OVERALL}' as kind, model, score, is_anomaly from scores
 {" ".join(f"union all select '{t}', model, score, is_anomaly from scores where not is_anomaly or anomaly_type = '{t}'" for t in ANOMALY_TYPES)}),
 hist as (select kind, model, score, count(*) filter (where is_anomaly) as pos, count(*) filter (where not is_anomaly) as neg from subsets group by kind, model, score),
 curve as (select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg, sum(pos) over (partition by kind, model) as p, sum(neg) over (partition by kind, model) as n
  from hist window w as (partition by kind, model order by score desc))"""

BEST = f"""best as (select model, score as threshold from (select *, row_number() over (partition by model order by {_F1} desc, score) as rn
 from curve where kind = '{OVERALL}') t where rn = 1)"""
_TOP = """best as (select model, min(score) as threshold from (select *, row_number() over (partition by model order by score desc) as rn,
 greatest(1, round_even(count(*) over (partition by model) * 0.05, 0)) as k from scores) t where rn <= k group by model)"""

METRICS = f"""aucs as (select kind, model, max(p) as p, max(n) as n, {_AP}, {_AUC} from curve group by kind, model),
 hits as (select kind, model, threshold, coalesce(sum(pos) filter (where score >= threshold), 0) as tp, coalesce(sum(neg) filter (where score >= threshold), 0) as fp
  from hist join best using (model) group by kind, model, threshold),
 metrics as (select model, kind as anomaly_type, cast(p + n as bigint) as "rows", cast(p as bigint) as anomaly_count, round(p / (p + n), 6) as anomaly_rate, pr_auc, roc_auc,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as "precision", round(coalesce(tp / nullif(p, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(tp + fp + p, 0), 0), 6) as f1, threshold from aucs join hits using (kind, model))"""

_METRIC_COLUMNS = ("pr_auc", "roc_auc", "precision", "recall", "f1")


def _rounded_metrics(metrics):
    return metrics.select(
        "model", "anomaly_type", "rows", "anomaly_count", r6("anomaly_rate"), *[r6(c) for c in _METRIC_COLUMNS], "threshold"
    )


@query("metrics_overall", f"with {SCORES_SQL}, {KINDS}, {BEST}, {METRICS} select * from metrics where anomaly_type = '{OVERALL}'")
def metrics_overall(spark, sf_dir):
    return _rounded_metrics(curve_metrics(score_curve(order_scores(spark, sf_dir), ()), ()))


@query("metrics_by_type", f"with {SCORES_SQL}, {KINDS}, {BEST}, {METRICS} select * from metrics")
def metrics_by_type(spark, sf_dir):
    return _rounded_metrics(curve_metrics(score_curve(order_scores(spark, sf_dir))))


@query("metrics_top_rate", f"with {SCORES_SQL}, {KINDS}, {_TOP}, {METRICS} select * from metrics")
def metrics_top_rate(spark, sf_dir):
    return _rounded_metrics(curve_metrics(score_curve(order_scores(spark, sf_dir)), top_rate=0.05))


_FIXED = "best as (select distinct model, cast(300000 as double) as threshold from scores)"


@query(
    "metrics_fixed_threshold",
    f"with {SCORES_SQL}, {KINDS}, {_FIXED}, {METRICS} select * from metrics",
)
def metrics_fixed_threshold(spark, sf_dir):
    return _rounded_metrics(curve_metrics(score_curve(order_scores(spark, sf_dir)), threshold=300000.0))


_LONG = " union all ".join(
    f"select model, concat('evaluation_{m}', case when anomaly_type = '{OVERALL}' then '' else concat('_', anomaly_type) end) as metric, \"{m}\" as value from metrics"
    for m in _METRIC_COLUMNS
)


@query("metrics_long", f"with {SCORES_SQL}, {KINDS}, {BEST}, {METRICS} {_LONG}")
def metrics_long_rows(spark, sf_dir):
    long = metrics_long(curve_metrics(score_curve(order_scores(spark, sf_dir))), _METRIC_COLUMNS)
    return long.select("model", "metric", r6("value"))


@query(
    "score_quantiles",
    f"""with {SCORES_SQL} select model, is_anomaly, round(quantile_cont(score, 0.05), 6) as p05, round(quantile_cont(score, 0.5), 6) as median,
 round(quantile_cont(score, 0.95), 6) as p95, round(avg(score), 6) as mean from scores group by model, is_anomaly""",
)
def score_quantiles(spark, sf_dir):
    wide = overall_diagnostics(order_scores(spark, sf_dir))
    sides = [
        F.struct(F.lit(flag).alias("is_anomaly"), *[r6(q, f"{side}_score_{q}") for q in ("p05", "median", "p95", "mean")])
        for side, flag in (("normal", False), ("anomaly", True))
    ]
    return wide.select("model", F.explode(F.array(*sides)).alias("e")).select("model", "e.*")


_SUMMARY = """summary as (select model, round(quantile_cont(score, 0.05) filter (where not is_anomaly), 6) as normal_score_p05,
 round(median(score) filter (where not is_anomaly), 6) as normal_score_median, round(quantile_cont(score, 0.95) filter (where not is_anomaly), 6) as normal_score_p95,
 round(avg(score) filter (where not is_anomaly), 6) as normal_score_mean, round(quantile_cont(score, 0.05) filter (where is_anomaly), 6) as anomaly_score_p05,
 round(median(score) filter (where is_anomaly), 6) as anomaly_score_median, round(quantile_cont(score, 0.95) filter (where is_anomaly), 6) as anomaly_score_p95,
 round(avg(score) filter (where is_anomaly), 6) as anomaly_score_mean from scores group by model)"""


@query(
    "diagnostics_overall",
    f"""with {SCORES_SQL}, {KINDS}, {_TOP}, {METRICS}, {_SUMMARY} select model, anomaly_count, anomaly_rate, pr_auc, roc_auc,
 "precision" as top_rate_precision, recall as top_rate_recall, threshold, summary.* exclude (model) from metrics join summary using (model)
 where anomaly_type = '{OVERALL}'""",
)
def diagnostics_overall(spark, sf_dir):
    found = overall_diagnostics(order_scores(spark, sf_dir))
    plain = {"model", "anomaly_count", "threshold"}
    return found.select(*[c if c in plain else r6(c) for c in found.columns])


_LIFTS = """normals as (select model, avg(score) as nm, median(score) as nd from scores where not is_anomaly group by model),
 lifts as (select model, anomaly_type, round(avg(score) - max(nm), 5) as score_lift_vs_normals, round(median(score) - max(nd), 5) as median_score_lift_vs_normals
  from scores join normals using (model) where is_anomaly group by model, anomaly_type),
 by_type as (select m.model, m.anomaly_type, anomaly_count, anomaly_rate as baseline_pr_auc, m.pr_auc,
  round(a.ap / (a.p / (a.p + a.n)), 5) as pr_auc_lift, m.roc_auc, score_lift_vs_normals, median_score_lift_vs_normals, recall as top_rate_recall
  from metrics m join lifts l using (model, anomaly_type)
  join (select kind, model, max(p) as p, max(n) as n, sum(pos * cum_pos / (cum_pos + cum_neg)) / max(p) as ap from curve group by kind, model) a
   on a.model = m.model and a.kind = m.anomaly_type)"""


def _rounded_types(found):
    r5 = {"pr_auc_lift", "score_lift_vs_normals", "median_score_lift_vs_normals"}
    plain = {"model", "anomaly_type", "anomaly_count"}
    return found.select(*[c if c in plain else F.round(c, 5 if c in r5 else 6).alias(c) for c in found.columns])


@query("diagnostics_by_type", f"with {SCORES_SQL}, {KINDS}, {_TOP}, {METRICS}, {_LIFTS} select * from by_type")
def diagnostics_by_type(spark, sf_dir):
    return _rounded_types(type_diagnostics(order_scores(spark, sf_dir)))


@query(
    "hardest_type",
    f"""with {SCORES_SQL}, {KINDS}, {_TOP}, {METRICS}, {_LIFTS} select * exclude (rn) from (select *, row_number() over (partition by model
 order by roc_auc, score_lift_vs_normals, anomaly_type) as rn from by_type) t where rn = 1""",
)
def hardest_type(spark, sf_dir):
    return _rounded_types(hardest_types(type_diagnostics(order_scores(spark, sf_dir))))


@query(
    "contamination_flags",
    """with o as (select quantile_cont(-o_totalprice, 0.05) as cut from orders)
 select o_orderkey as source_row_id, -o_totalprice as score_samples, -o_totalprice < cut as is_anomaly from orders, o""",
)
def contamination_flags(spark, sf_dir):
    """Rows below the fifth percentile of their own scores."""
    scored = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("source_row_id"), (-F.col("o_totalprice")).alias("score_samples")
    )
    cut = exact_quantiles(scored, {"s": F.col("score_samples")}, [0.05])["s"][0]
    return scored.withColumn("is_anomaly", F.col("score_samples") < F.lit(cut))
