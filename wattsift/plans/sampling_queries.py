"""Queries over sampling, splitting, allocation and feature preparation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from wattsift.estimators import Preparation
from wattsift.operators.order_stats import boundaries, exact_quantiles
from wattsift.operators.prep import (
    category_counts,
    category_frequencies,
    category_modes,
    encode_categories,
    fit_preprocessor,
    number_stats,
    transform,
)
from wattsift.operators.sample import allocate_counts, exclude_ids, sample_exact, split_evaluation
from wattsift.plans.catalog import ORACLES, query
from wattsift.plans.energy_view import table
from wattsift.plans.oracle_parts import ALLOCATED, CLEAN, P, draw
from wattsift.plans.shared import clean_energy, once
from wattsift.profile import DEFAULT_WEIGHTS
from wattsift.session import scratch_path
from wattsift.sources.snapshots import write_version
from wattsift.streaming.summaries import fit_summarised, update_summaries


@query("sample_exact", f"select o_orderkey as source_row_id, o_totalprice from orders order by {draw(42, 'sample', 'o_orderkey')}, o_orderkey limit 5000")
def sample_exact_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_row_id"), "o_totalprice")
    return sample_exact(orders, 5000)


@query(
    "sample_excluding",
    f"""select o_orderkey as source_row_id, o_totalprice from orders
 where o_orderkey not in (select l_orderkey from lineitem where l_quantity >= 40)
 order by {draw(7, "sample", "o_orderkey")}, o_orderkey limit 2000""",
)
def sample_excluding(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_row_id"), "o_totalprice")
    large = table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") >= 40)
    return sample_exact(orders, 2000, 7, exclude=large.select(F.col("l_orderkey").alias("source_row_id")))


@query(
    "exclude_ids",
    "select c_custkey, c_acctbal from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')",
)
def exclude_id_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    pending = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    return exclude_ids(customer, pending.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


_SPLIT = f"""with t as (select o_orderkey as source_row_id, o_orderpriority = '1-URGENT' as is_anomaly from orders),
 r as (select *, row_number() over (partition by is_anomaly order by {draw(42, "split", "source_row_id")}, source_row_id) as rn,
  count(*) over (partition by is_anomaly) as n from t)
 select source_row_id, is_anomaly, case when rn <= round_even(n * 0.3, 0) then 'validation' else 'test' end as part from r"""


@query("split_stratified", _SPLIT)
def split_stratified(spark, sf_dir):
    flagged = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("source_row_id"), (F.col("o_orderpriority") == "1-URGENT").alias("is_anomaly")
    )
    validation, test = split_evaluation(flagged, 0.3)
    return validation.withColumn("part", F.lit("validation")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "split_unlabelled",
    f"""with r as (select o_orderkey as source_row_id, row_number() over (order by {draw(11, "split", "o_orderkey")}, o_orderkey) as rn,
 count(*) over () as n from orders) select source_row_id from r where rn <= round_even(n * 0.5, 0)""",
)
def split_unlabelled(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_row_id"))
    return split_evaluation(rows, 0.5, 11)[0]


@query(
    "allocate_counts",
    f"""with wanted as (select cast(round_even(count(*) * cast(0.05 as double), 0) as bigint) as wanted from lineitem),
 {ALLOCATED} select name as anomaly_type, n from alloc""",
)
def allocate_count_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").count()
    counts = allocate_counts(round(rows * 0.05), DEFAULT_WEIGHTS)
    return spark.createDataFrame(list(counts.items()), "anomaly_type string, n long")


_LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _line_quantiles() -> str:
    return " union all ".join(
        f"select '{c}' as feature, round(quantile_cont({c}, 0.05), 6) as p05, round(quantile_cont({c}, 0.5), 6) as p50,"
        f" round(quantile_cont({c}, 0.95), 6) as p95 from lineitem"
        for c in _LINE
    )


@query("exact_quantiles", _line_quantiles())
def line_quantiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*_LINE)
    found = exact_quantiles(lines, {c: F.col(c) for c in _LINE}, [0.05, 0.5, 0.95])
    rows = [(c, *[round(v, 6) for v in found[c]]) for c in _LINE]
    return spark.createDataFrame(rows, "feature string, p05 double, p50 double, p95 double")


@query(
    "top_slice",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity from (select *, row_number() over (order by l_quantity desc, l_partkey) as rn,
 rank() over (order by l_quantity desc, l_partkey) as rk from lineitem) t where rk <= 1000""",
)
def top_slice(spark, sf_dir):
    """First thousand lines by (quantity, part) with heavy ties on quantity, as a filter by one boundary key."""
    lines = table(spark, sf_dir, "lineitem")
    value, rid = -F.col("l_quantity"), F.col("l_partkey")
    edge = boundaries(lines, value, rid, [1000])[0]
    return lines.filter(edge.covers(value, rid)).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def _filled(c: str) -> str:
    return f"coalesce({c}, (select median({c}) from clean))"


_STATS = " union all ".join(
    f"select '{c}' as feature, round((select median({c}) from clean), 6) as median, round(avg({_filled(c)}), 6) as mean,"
    f" round(stddev_pop({_filled(c)}), 6) as deviation from clean"
    for c in P.numeric
)


@query("impute_median", f"with {CLEAN} {_STATS}")
def impute_median(spark, sf_dir):
    rows = [(n, *[round(x, 6) for x in rest]) for n, *rest in number_stats(clean_energy(spark, sf_dir), P.numeric)]
    return spark.createDataFrame(rows, "feature string, median double, mean double, deviation double")


_CELLS = " union all ".join(f"select '{c}' as feature, cast({c} as varchar) as value from clean" for c in P.categoricals)
CATEGORIES = f"""{CLEAN}, cells as ({_CELLS}),
 counted as (select feature, value, count(*) as n from cells group by feature, value),
 modes as (select feature, value as mode from (select *, row_number() over (partition by feature order by n desc, value) as rn
  from counted where value is not null) t where rn = 1),
 filled as (select feature, coalesce(value, mode) as value, n from counted join modes using (feature)),
 freq as (select feature, value, sum(n) / sum(sum(n)) over (partition by feature) as frequency, sum(n) as n from filled group by feature, value)"""


@query("impute_mode", f"with {CATEGORIES} select feature, mode from modes")
def impute_mode(spark, sf_dir):
    return category_modes(category_counts(clean_energy(spark, sf_dir), P.categoricals))


@query("freq_encode", f"with {CATEGORIES} select feature, value, round(frequency, 9) as frequency from freq")
def freq_encode(spark, sf_dir):
    counts = category_counts(clean_energy(spark, sf_dir), P.categoricals)
    return category_frequencies(counts).select("feature", "value", F.round("frequency", 9).alias("frequency"))


_UNSEEN_CELLS = " union all ".join(
    f"select '{c}' as feature, cast({c} as varchar) as value from clean where {P.occupation} <> '2'" for c in P.categoricals
)


@query(
    "freq_encode_unseen",
    f"""with {CLEAN}, cells as ({_UNSEEN_CELLS}),
 counted as (select feature, value, count(*) as n from cells group by feature, value),
 modes as (select feature, value as mode from (select *, row_number() over (partition by feature order by n desc, value) as rn
  from counted where value is not null) t where rn = 1),
 filled as (select feature, coalesce(value, mode) as value, n from counted join modes using (feature)),
 freq as (select feature, value, sum(n) / sum(sum(n)) over (partition by feature) as frequency from filled group by feature, value)
 select source_row_id, {", ".join(f"round(coalesce(f{i}.frequency, 0), 9) as {c}" for i, c in enumerate(P.categoricals))} from clean
 {" ".join(f"left join freq f{i} on f{i}.feature = '{c}' and f{i}.value = coalesce(cast(clean.{c} as varchar), (select mode from modes where feature = '{c}'))" for i, c in enumerate(P.categoricals))}""",
)
def freq_encode_unseen(spark, sf_dir):
    """Fitted without one occupation class, applied to all rows: its codes are unseen and become 0."""
    clean = clean_energy(spark, sf_dir)
    pre = fit_preprocessor(clean.filter(F.col(P.occupation) != "2"))
    coded = encode_categories(clean.select("source_row_id", *P.categoricals), pre)
    return coded.select("source_row_id", *[F.round(c, 9).alias(c) for c in P.categoricals])


def scaled_sql(value: str, mean: str, deviation: str) -> str:
    return f"({value} - {mean}) / case when {deviation} <= 1e-14 then 1 else {deviation} end"


ENCODED = f"""{CATEGORIES},
 coded as (select clean.*, {", ".join(f"f{i}.frequency as k{i}" for i in range(len(P.categoricals)))} from clean
 {" ".join(f"join freq f{i} on f{i}.feature = '{c}' and f{i}.value = coalesce(cast(clean.{c} as varchar), (select mode from modes where feature = '{c}'))" for i, c in enumerate(P.categoricals))}),
 meds as (select {", ".join(f"median({c}) as {c}" for c in P.numeric)} from clean),
 full_rows as (select source_row_id, {", ".join(f"k{i}" for i in range(len(P.categoricals)))},
  {", ".join(f"coalesce(coded.{c}, meds.{c}) as {c}" for c in P.numeric)} from coded, meds)"""


@query(
    "preprocessor_24",
    f"""with {ENCODED}, moments as (select {", ".join(f"avg(k{i}) as mk{i}, stddev_pop(k{i}) as sk{i}" for i in range(len(P.categoricals)))},
 {", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in P.numeric)} from full_rows)
 select source_row_id, {", ".join(f"round({scaled_sql(f'k{i}', f'mk{i}', f'sk{i}')}, 5) as {c}" for i, c in enumerate(P.categoricals))},
 {", ".join(f"round({scaled_sql(c, f'm_{c}', f's_{c}')}, 5) as {c}" for c in P.numeric)} from full_rows, moments""",
)
def preprocessor_24(spark, sf_dir):
    clean = clean_energy(spark, sf_dir)
    encoded = transform(clean.select("source_row_id", *P.features), fit_preprocessor(clean))
    return encoded.select("source_row_id", *[F.round(c, 5).alias(c) for c in P.encoded])


@query("pipeline_prepared", ORACLES["preprocessor_24"])
def pipeline_prepared(spark, sf_dir):
    """The same by a fitted pipeline that was saved and read."""
    path, clean = scratch_path(spark, "pipeline"), clean_energy(spark, sf_dir)
    Pipeline(stages=[Preparation()]).fit(clean).write().save(path)
    found = PipelineModel.load(path).transform(clean.select("source_row_id", *P.features))
    return found.select("source_row_id", *[F.round(F.get("features", F.lit(i)), 5).alias(c) for i, c in enumerate(P.encoded)])


@query(
    "scale_lines",
    f"""with m as (select {", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in _LINE)} from lineitem)
 select l_orderkey, l_linenumber, l_partkey, l_suppkey, {", ".join(f"round(({c} - m_{c}) / s_{c}, 5) as {c}" for c in _LINE)} from lineitem, m""",
)
def scale_lines(spark, sf_dir):
    """Population scaling of plain numeric columns."""
    lines = table(spark, sf_dir, "lineitem")
    stats = {n: (mean, deviation) for n, _, mean, deviation in number_stats(lines, _LINE)}
    scaled = [F.round((F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1]), 5).alias(c) for c in _LINE]
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *scaled)


# ---- fits that follow new versions ----

_VERSIONS = ("2026-01-01", "2026-02-01", "2026-03-01")
_SAFE = "case when deviation <= 1e-9 then 1.0 else deviation end"
_CODES = "select feature, sum(frequency * frequency) as mean, sqrt(greatest(sum(frequency * frequency * frequency) - pow(sum(frequency * frequency), 2), 0)) as deviation from freq group by feature"


def _followed(spark, sf_dir):
    """The clean table in three versions, of which the last arrives after the first two were summarised."""

    def build():
        root, store, clean = scratch_path(spark, "versions"), scratch_path(spark, "summaries"), clean_energy(spark, sf_dir)
        for i, version in enumerate(_VERSIONS):
            write_version(clean.filter(F.pmod("source_row_id", F.lit(3)) == i), root, version)
            if i and update_summaries(spark, root, store) != list(_VERSIONS[2 * i - 2 : i + 1]):
                raise RuntimeError("a version was summarised twice or not at all")
        return fit_summarised(spark.read.option("basePath", root).parquet(root), store)

    return once("followed", spark, sf_dir, build)


@query(
    "fit_versions",
    f"""with {CATEGORIES}, numbers as ({_STATS}), codes as ({_CODES})
 select feature, 'number' as kind, median as fill_number, null as fill_text, mean, {_SAFE} as scale from numbers
 union all select feature, 'category', null, mode, round(mean, 6), round({_SAFE}, 6) from codes join modes using (feature)""",
)
def fit_versions(spark, sf_dir):
    """Medians, modes, means and scales by summaries of versions: those of a fit over the whole table."""
    stats = _followed(spark, sf_dir).stats
    rounded = [F.round(c, 6).alias(c) for c in ("fill_number", "mean", "scale")]
    return stats.select("feature", "kind", "fill_text", *rounded)


@query("fit_versions_frequencies", f"with {CATEGORIES} select feature, value, round(frequency, 9) as frequency from freq")
def fit_versions_frequencies(spark, sf_dir):
    return _followed(spark, sf_dir).frequencies.select("feature", "value", F.round("frequency", 9).alias("frequency"))
