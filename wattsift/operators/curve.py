"""One score curve per model, and every ranking or threshold metric read from it.

The curve is the table of distinct scores with counts of normal and anomalous rows, overall and per
anomaly type, and their running totals from the highest score down.  Counting per score first folds
ties and hot scores on the map side.  The running total has two levels: scores are cut into ordered
buckets, whole buckets are summed, and a window runs inside each bucket only, so no task ever sees
the whole table.  Per-type metrics need no copy of the normal rows: each type is one more counter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattsift.functions.numbers import ratio_or_zero
from wattsift.operators.order_stats import DIRECT_ROWS, boundaries_by_name, exact_quantiles, values_at_ranks
from wattsift.profile import ANOMALY_TYPES

OVERALL = "__all__"
ROWS_PER_BUCKET = 2_000_000
TOP_K_SCHEMA = "model string, anomaly_type string, k long, precision_at_k double, recall_at_k double"


def as_scores(
    df: DataFrame,
    score: str = "score",
    label: str = "is_anomaly",
    kind: str | None = "anomaly_type",
    model: str | None = "model",
    row_id: str = "source_row_id",
) -> DataFrame:
    """Long form (model, source_row_id, score, is_anomaly, anomaly_type) the metrics read."""
    flag = F.col(label).cast("boolean")
    name = F.col(model) if model and model in df.columns else F.lit("model")
    family = F.col(kind) if kind and kind in df.columns else F.when(flag, F.lit("anomaly")).otherwise(F.lit("none"))
    return df.select(
        name.alias("model"),
        F.col(row_id).alias("source_row_id"),
        F.col(score).cast("double").alias("score"),
        flag.alias("is_anomaly"),
        family.alias("anomaly_type"),
    )


def row_counts(scores: DataFrame) -> dict[str, int]:
    """Rows per model; a row without a score, a label or a model is an error, not a row left out."""
    bad = F.col("score").isNull() | F.isnan("score") | F.col("is_anomaly").isNull() | F.col("model").isNull()
    found = scores.groupBy("model").agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad")).collect()
    unusable = sum(r["bad"] for r in found)
    if unusable:
        raise ValueError(f"{unusable} of {sum(r['rows'] for r in found)} rows have no score, label or model.")
    return {r["model"]: r["rows"] for r in found}


def _bucketed(scores: DataFrame, rows_per_bucket: int) -> DataFrame:
    """Adds ``bucket``, rising with the score; their number follows the rows, one for a small table."""
    wanted = math.ceil(sum(row_counts(scores).values()) / rows_per_bucket)
    if wanted <= 1:
        return scores.withColumn("bucket", F.lit(0.0))
    marks = [i / wanted for i in range(1, wanted)]
    cuts = scores.groupBy("model").agg(F.percentile_approx("score", marks, 10 * wanted).alias("cuts")).collect()
    names, bucket = [], F.lit(None).cast("double")
    for i, r in enumerate(cuts):
        inner = sorted({c for c in r["cuts"] if math.isfinite(c)})
        if inner:
            side = f"__bucket_{i}"
            scores = Bucketizer(
                splits=[-math.inf, *inner, math.inf], inputCol="score", outputCol=side, handleInvalid="keep"
            ).transform(scores)
            names.append(side)
            bucket = F.coalesce(F.when(F.col("model") == r["model"], F.col(side)), bucket)
    return scores.withColumn("bucket", F.coalesce(bucket, F.lit(0.0))).drop(*names)


def score_curve(scores: DataFrame, types: Sequence[str] = ANOMALY_TYPES, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(model, score, neg, pos, pos_<type>..., cum_..., all_pos, all_neg) per distinct score, descending totals.

    Rows without a score or label raise.
    """
    counters = {"neg": F.count_if(~F.col("is_anomaly")), "pos": F.count_if(F.col("is_anomaly"))}
    for t in types:
        counters[f"pos_{t}"] = F.count_if(F.col("is_anomaly") & (F.col("anomaly_type") == t))
    # adding 0.0 folds -0.0 into 0.0, which a bucket search would keep apart
    bucketed = _bucketed(scores.withColumn("score", F.col("score") + F.lit(0.0)), rows_per_bucket)
    tallied = bucketed.groupBy("model", "bucket", "score").agg(*[c.alias(n) for n, c in counters.items()])

    higher = Window.partitionBy("model").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("model")
    # one row per bucket of ROWS_PER_BUCKET rows
    above = (
        tallied.groupBy("model", "bucket")
        .agg(*[F.sum(n).alias(n) for n in counters])
        .select(
            "model",
            "bucket",
            *[F.coalesce(F.sum(n).over(higher), F.lit(0)).alias(f"above_{n}") for n in counters],
            *[F.sum(n).over(whole).alias(f"all_{n}") for n in ("pos", "neg")],
        )
    )
    inside = Window.partitionBy("model", "bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        tallied.withColumns({f"cum_{n}": F.sum(n).over(inside) for n in counters})
        .join(F.broadcast(above), ["model", "bucket"])
        .select(
            "model",
            "score",
            *counters,
            *[(F.col(f"cum_{n}") + F.col(f"above_{n}")).alias(f"cum_{n}") for n in counters],
            "all_pos",
            "all_neg",
        )
    )


def pr_points(curve: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score."""
    return curve.select(
        "model",
        "score",
        "cum_pos",
        "cum_neg",
        ratio_or_zero(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        ratio_or_zero(F.col("cum_pos"), F.col("all_pos")).alias("recall"),
    )


def _average_precision(pos: str) -> Column:
    """Step sum: precision at each distinct score, weighted by the recall gained there; null without positives."""
    p, cp, cn = F.col(pos), F.col(f"cum_{pos}"), F.col("cum_neg")
    step = F.when(p > 0, p * cp.cast("double") / (cp + cn))
    return F.try_divide(F.sum(step), F.sum(p).cast("double"))


def _roc_auc(pos: str) -> Column:
    """Share of (normal, anomaly) pairs in the right order, ties half; null with one class only."""
    p, cp, n = F.col(pos), F.col(f"cum_{pos}"), F.col("neg")
    wins = F.sum(n.cast("double") * (cp - p / 2.0))
    return F.try_divide(wins, F.sum(p).cast("double") * F.sum(n).cast("double"))


def curve_metrics(
    curve: DataFrame,
    types: Sequence[str] = ANOMALY_TYPES,
    threshold: float | None = None,
    top_rate: float | None = None,
) -> DataFrame:
    """Metrics per model, overall and per type, from one aggregate over the curve.

    Threshold: the given one; or with ``top_rate`` the score of the k-th row, k = max(1, round(rate*n));
    or else the one with the best F1 over all rows, the smallest on a tie.  A type is judged on its own
    rows plus all normal rows at the shared threshold; types without rows are left out.
    """
    kinds = [("pos", OVERALL), *[(f"pos_{t}", t) for t in types]]
    at = F.struct(F.col("score"), F.col("cum_neg"), *[F.col(f"cum_{c}") for c, _ in kinds])
    if threshold is not None:
        chosen = F.min(F.when(F.col("score") >= F.lit(float(threshold)), at))
    elif top_rate is not None:
        k = F.greatest(F.lit(1.0), F.rint((F.col("all_pos") + F.col("all_neg")) * F.lit(float(top_rate))))
        chosen = F.max(F.when(F.col("cum_pos") + F.col("cum_neg") >= k, at))
    else:
        f1 = ratio_or_zero(2 * F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg") + F.col("all_pos"))
        chosen = F.max_by(at, F.struct(f1, -F.col("score")))
    parts = [chosen.alias("at"), F.sum("neg").alias("neg")]
    for c, _ in kinds:
        parts += [F.sum(c).alias(c), _average_precision(c).alias(f"ap_{c}"), _roc_auc(c).alias(f"auc_{c}")]
    wide = curve.groupBy("model").agg(*parts)

    def entry(column: str, kind: str) -> Column:
        return F.struct(
            F.lit(kind).alias("anomaly_type"),
            (F.col(column) + F.col("neg")).alias("rows"),
            F.col(column).alias("anomaly_count"),
            F.col(f"ap_{column}").alias("pr_auc"),
            F.col(f"auc_{column}").alias("roc_auc"),
            F.coalesce(F.col(f"at.cum_{column}"), F.lit(0)).alias("tp"),
            F.coalesce(F.col("at.cum_neg"), F.lit(0)).alias("fp"),
        )

    limit = F.lit(float(threshold)) if threshold is not None else F.col("at.score")
    long = wide.select("model", limit.alias("threshold"), F.explode(F.array(*[entry(c, k) for c, k in kinds])).alias("e"))
    tp, fp, p = F.col("e.tp"), F.col("e.fp"), F.col("e.anomaly_count")
    return long.filter((F.col("e.anomaly_type") == OVERALL) | (p > 0)).select(
        "model",
        F.col("e.anomaly_type").alias("anomaly_type"),
        F.col("e.rows").alias("rows"),
        p.alias("anomaly_count"),
        ratio_or_zero(p, F.col("e.rows")).alias("anomaly_rate"),
        F.col("e.pr_auc").alias("pr_auc"),
        F.col("e.roc_auc").alias("roc_auc"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, p).alias("recall"),
        ratio_or_zero(2 * tp, tp + fp + p).alias("f1"),
        "threshold",
    )


def best_f1_threshold(curve: DataFrame) -> DataFrame:
    """(model, threshold); +inf for an empty curve is the caller's default."""
    return curve_metrics(curve, types=()).select("model", "threshold")


def top_rate_threshold(scores: DataFrame, rate: float = 0.05, direct_rows: int = DIRECT_ROWS) -> dict[str, float]:
    """Score of the k-th row from the top per model, without building the curve."""
    counts = row_counts(scores)
    values = {m: F.when(F.col("model") == m, F.col("score")) for m in counts}
    ranks = {m: [n - max(1, round(n * rate)) + 1] for m, n in counts.items()}
    hits = values_at_ranks(scores, values, ranks, counts, direct_rows=direct_rows)
    return {m: hits[(m, ranks[m][0])].value for m in counts}


def top_k_metrics(
    scores: DataFrame,
    ks: Sequence[int],
    types: Sequence[str] | None = None,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Precision and recall among the k highest scores, ties by row id; per model, overall and per type.

    Each (model, subset, k) is one boundary key, and all are counted in one aggregate.
    """
    models = sorted(row_counts(scores))
    family = {OVERALL: F.lit(True)}
    for t in types or ():
        family[t] = ~F.col("is_anomaly") | (F.col("anomaly_type") == t)
    subsets = {(m, t): (F.col("model") == m) & test for m in models for t, test in family.items()}
    if not subsets:
        return scores.sparkSession.createDataFrame([], TOP_K_SCHEMA)
    sizes = scores.agg(
        *[F.count_if(s).alias(f"n{i}") for i, s in enumerate(subsets.values())],
        *[F.count_if(s & F.col("is_anomaly")).alias(f"p{i}") for i, s in enumerate(subsets.values())],
    ).first()
    down, rid = -F.col("score"), F.col("source_row_id")
    plan, hits = [], []
    ranked, counts, positives = {}, {}, {}
    for i, (name, subset) in enumerate(subsets.items()):
        if name[1] != OVERALL and sizes[f"p{i}"] == 0:
            continue
        for k in ks:
            if not 1 <= k <= sizes[f"n{i}"]:
                raise ValueError(f"there is no top {k} of {sizes[f'n{i}']} rows")
        ranked[name], counts[name], positives[name] = F.when(subset, down), sizes[f"n{i}"], sizes[f"p{i}"]
    edges = boundaries_by_name(scores, ranked, rid, {n: list(ks) for n in ranked}, counts, direct_rows=direct_rows)
    for name in ranked:
        for k, edge in zip(ks, edges[name], strict=True):
            hits.append(F.count_if(subsets[name] & edge.covers(down, rid) & F.col("is_anomaly")).alias(f"h{len(plan)}"))
            plan.append((*name, int(k), positives[name]))
    row = scores.agg(*hits).first()
    found = [(m, t, k, row[f"h{j}"] / k, row[f"h{j}"] / p if p else 0.0) for j, (m, t, k, p) in enumerate(plan)]
    return scores.sparkSession.createDataFrame(found, TOP_K_SCHEMA)


def calculate_metrics(
    scores: DataFrame,
    threshold: float | None = None,
    ks: Sequence[int] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> dict[str, float]:
    """Overall metrics of one model as a dict."""
    curve = score_curve(scores, (), rows_per_bucket)
    row = curve_metrics(curve, (), threshold).first()
    if row is None:
        return {"threshold": math.inf}
    result = {n: row[n] for n in ("pr_auc", "roc_auc", "precision", "recall", "f1", "threshold")}
    if ks:
        for r in top_k_metrics(scores, ks).collect():
            result[f"precision_at_{r['k']}"] = r["precision_at_k"]
            result[f"recall_at_{r['k']}"] = r["recall_at_k"]
    return result


# ---- diagnostics over a long table of scores of several models ----


def _models(scores: DataFrame) -> list[str]:
    return sorted(r["model"] for r in scores.select("model").distinct().collect())


def overall_diagnostics(scores: DataFrame, rate: float = 0.05) -> DataFrame:
    """One row per model: curve metrics at the top-rate threshold and score summaries of both classes."""
    if not 0 < rate < 1:
        raise ValueError(f"rate is a share of the rows, above 0 and below 1: {rate}")
    groups = {"normal": ~F.col("is_anomaly"), "anomaly": F.col("is_anomaly")}
    models = _models(scores)
    values = {(m, g): F.when((F.col("model") == m) & test, F.col("score")) for m in models for g, test in groups.items()}
    spreads = exact_quantiles(scores, values, [0.05, 0.50, 0.95])
    summary = [
        (m, *[x for g in groups for x in spreads[(m, g)]])
        for m in models
    ]
    columns = ", ".join(f"{g}_score_{q} double" for g in groups for q in ("p05", "median", "p95"))
    quantiles = scores.sparkSession.createDataFrame(summary, f"model string, {columns}")
    means = scores.groupBy("model").agg(*[F.avg(F.when(t, F.col("score"))).alias(f"{g}_score_mean") for g, t in groups.items()])
    metrics = curve_metrics(score_curve(scores, ()), (), top_rate=rate).select(
        "model",
        "anomaly_count",
        "anomaly_rate",
        "pr_auc",
        "roc_auc",
        F.col("precision").alias("top_rate_precision"),
        F.col("recall").alias("top_rate_recall"),
        "threshold",
    )
    return metrics.join(F.broadcast(quantiles), "model").join(F.broadcast(means), "model")


def type_diagnostics(scores: DataFrame, rate: float = 0.05, types: Sequence[str] = ANOMALY_TYPES) -> DataFrame:
    """One row per (model, type): prevalence baseline, lifts over it and over the normal rows."""
    models = _models(scores)
    family = {t: F.col("is_anomaly") & (F.col("anomaly_type") == t) for t in types}
    groups = {"__normal__": ~F.col("is_anomaly"), **family}
    values = {(m, g): F.when((F.col("model") == m) & test, F.col("score")) for m in models for g, test in groups.items()}
    medians = exact_quantiles(scores, values, [0.5])
    means = {r["model"]: r for r in scores.groupBy("model").agg(*[F.avg(F.when(t, F.col("score"))).alias(g) for g, t in groups.items()]).collect()}
    rows = []
    for m in models:
        for t in types:
            if means[m][t] is not None:
                normal_mean, normal_median = means[m]["__normal__"], medians[(m, "__normal__")][0]
                lift = None if normal_mean is None else means[m][t] - normal_mean
                median_lift = None if normal_median is None else medians[(m, t)][0] - normal_median
                rows.append((m, t, lift, median_lift))
    lifts = scores.sparkSession.createDataFrame(
        rows, "model string, anomaly_type string, score_lift_vs_normals double, median_score_lift_vs_normals double"
    )
    metrics = curve_metrics(score_curve(scores, types), types, top_rate=rate).filter(F.col("anomaly_type") != OVERALL)
    return metrics.join(F.broadcast(lifts), ["model", "anomaly_type"]).select(
        "model",
        "anomaly_type",
        "anomaly_count",
        F.col("anomaly_rate").alias("baseline_pr_auc"),
        "pr_auc",
        F.try_divide("pr_auc", "anomaly_rate").alias("pr_auc_lift"),
        "roc_auc",
        "score_lift_vs_normals",
        "median_score_lift_vs_normals",
        F.col("recall").alias("top_rate_recall"),
    )


def hardest_types(by_type: DataFrame) -> DataFrame:
    """Per model the lowest ROC-AUC, then the lowest lift; the first non-null value of every column."""
    order = F.struct(
        F.col("roc_auc").isNull(), F.col("roc_auc"), F.col("score_lift_vs_normals").isNull(), F.col("score_lift_vs_normals"),
        F.col("anomaly_type"),
    )
    others = [c for c in by_type.columns if c != "model"]
    firsts = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in others]
    return by_type.groupBy("model").agg(*firsts)


def metrics_long(metrics: DataFrame, names: Sequence[str], prefix: str = "evaluation") -> DataFrame:
    """(model, metric, value) rows named ``prefix_name`` overall and ``prefix_name_type`` per type."""
    long = metrics.unpivot(["model", "anomaly_type"], list(names), "name", "value")
    tail = F.when(F.col("anomaly_type") != OVERALL, F.col("anomaly_type"))
    return long.filter(F.col("value").isNotNull()).select(
        "model", F.concat_ws("_", F.lit(prefix), "name", tail).alias("metric"), "value"
    )
