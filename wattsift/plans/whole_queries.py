"""Whole results of operators of which other queries show a part: every check, both halves, all columns, all files."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattsift.operators.clean import quoted
from wattsift.operators.curve import OVERALL, curve_metrics, score_curve
from wattsift.operators.inject import audit_counts, inject_anomalies
from wattsift.operators.sample import split_evaluation
from wattsift.plans.catalog import ORACLES, query
from wattsift.plans.energy_view import raw_energy, table
from wattsift.plans.injection_queries import _CHANGED, _FULL
from wattsift.plans.metric_queries import BEST, KINDS, METRICS
from wattsift.plans.oracle_parts import ADJUSTED, BRUT, CLEAN, INJECT, RAW, P, draw, rounded
from wattsift.plans.shared import SCORES_SQL, clean_energy, order_scores, r6
from wattsift.session import scratch_path
from wattsift.sources.csv_locale import scan_locale_csv
from wattsift.sources.reports import METRICS as REPORTED
from wattsift.sources.reports import as_json, comparison, read_results, write_csv
from wattsift.sources.snapshots import clean_snapshot, publish, table_digest

_FLIPPED = {P.shares_valid: f"{P.year} = '2023'", P.splits_valid: f"{P.occupation} = '1B'"}
_RAISED = {P.shares_sum: f"{P.occupation} = '2'", P.splits_sum: f"{P.year} = '2020'", P.delta: f"{P.year} = '2022'"}
_NO_ID = f"{P.occupation} = '2' and {P.year} = '2021'"


@query(
    "audit_all_checks",
    f"""with {CLEAN}, spoiled as (select *, not ({P.shares_valid} and {P.splits_valid}) as is_anomaly,
 {", ".join(f"case when {w} then not {c} else {c} end as seen_{c}" for c, w in _FLIPPED.items())} from clean)
select count(*) as "rows", count(*) filter (where is_anomaly) as anomalies, count(*) filter (where {_NO_ID}) as bad_missing_id,
 count(*) filter (where is_anomaly and coalesce({P.year} = '2021', false)) as bad_anomaly_type, count(*) filter (where not is_anomaly) as bad_clean_type,
 count(*) filter (where is_anomaly and not seen_{P.shares_valid}) as bad_mix, count(*) filter (where is_anomaly and not seen_{P.splits_valid}) as bad_split,
 {", ".join(f"count(*) filter (where {w}) as bad_{c}" for c, w in _FLIPPED.items())},
 {", ".join(f"count(*) filter (where {w} and {c} is not null) as bad_{c}" for c, w in _RAISED.items())} from spoiled""",
)
def audit_all_checks(spark, sf_dir):
    """Every fault the audit knows, put into the clean table: all its counts."""
    clean = clean_energy(spark, sf_dir).withColumn("is_anomaly", ~(F.col(P.shares_valid) & F.col(P.splits_valid)))
    spoiled = {c: F.when(F.expr(w), ~F.col(c)).otherwise(F.col(c)) for c, w in _FLIPPED.items()}
    spoiled |= {c: F.when(F.expr(w), F.col(c) + 1).otherwise(F.col(c)) for c, w in _RAISED.items()}
    spoiled |= {
        P.row_id: F.when(~F.coalesce(F.expr(_NO_ID), F.lit(False)), F.col(P.row_id)),
        "anomaly_type": F.when(F.col(P.year) == "2021", "unknown").otherwise("energy_mix"),
    }
    return audit_counts(clean.withColumns(spoiled))


@query(
    "split_unlabelled_parts",
    f"""with r as (select o_orderkey as source_row_id, row_number() over (order by {draw(11, "split", "o_orderkey")}, o_orderkey) as rn,
 count(*) over () as n from orders) select source_row_id, case when rn <= round_even(n * 0.5, 0) then 'validation' else 'test' end as part from r""",
)
def split_unlabelled_parts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_row_id"))
    parts = split_evaluation(rows, 0.5, 11)
    return parts[0].withColumn("part", F.lit("validation")).unionByName(parts[1].withColumn("part", F.lit("test")))


@query("inject_from_all_rows", f"with {INJECT.replace(f' where {P.shares_valid} and {P.splits_valid})', ')')} select {', '.join(_FULL)}, {rounded(_CHANGED)} from labelled")
def inject_from_all_rows(spark, sf_dir):
    """Targets drawn from all rows, valid or not, as injection does unless told otherwise; not audited."""
    return inject_anomalies(clean_energy(spark, sf_dir), audit=False).select(*_FULL, *[r6(c) for c in _CHANGED])


# ---- files ----

_DOUBLES = tuple(f"{c[:-4]}_%" for c in P.splits + P.shares)
_LONGS = (BRUT, *P.counts)
_TEXTS = (P.year, P.occupation, *P.context[:2], ADJUSTED)


def _written_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "csv")
    raw = raw_energy(spark, sf_dir).repartitionByRange("source_row_id").sortWithinPartitions("source_row_id")
    comma = [F.replace(quoted(c).cast("string"), F.lit("."), F.lit(",")).alias(c) for c in _DOUBLES]
    whole = raw.select(F.col("source_row_id").alias("original_id"), *_TEXTS, *_LONGS, *comma)
    whole.write.option("header", True).option("sep", ";").csv(path)
    return path


@query(
    "csv_whole_table",
    f"""with {RAW} select row_number() over (order by source_row_id) - 1 as source_row_id, source_row_id as original_id, {", ".join(_TEXTS)},
 cast({BRUT} as bigint) as {BRUT}, {", ".join(P.counts)}, {", ".join(f'"{c}" as {c[:-2]}' for c in _DOUBLES)} from raw""",
)
def csv_whole_table(spark, sf_dir):
    """All columns of the raw table through locale text: types found by inference, dense ids in file order."""
    scanned = scan_locale_csv(spark, _written_csv(spark, sf_dir), row_id="source_row_id")
    return scanned.withColumnsRenamed({c: c[:-2] for c in _DOUBLES})


@query(
    "csv_whole_types",
    f"""with {RAW}, t as (select count(*) as n from raw), kinds(column_name, kind) as (values ('original_id', 'long'),
 {", ".join(f"('{c}', 'string')" for c in _TEXTS)}, {", ".join(f"('{c}', 'long')" for c in _LONGS)}, {", ".join(f"('{c}', 'double')" for c in _DOUBLES)}) select column_name, kind, n from kinds, t""",
)
def csv_whole_types(spark, sf_dir):
    scanned = scan_locale_csv(spark, _written_csv(spark, sf_dir))
    names = {"bigint": "long"}
    kinds = [(f.name, names.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in scanned.schema.fields]
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind")) for c, k in kinds])
    return scanned.agg(F.count("*").alias("n")).select("n", F.explode(cells).alias("e")).select("e.*", "n")


@query("clean_snapshot_rows", ORACLES["clean_all"])
def clean_snapshot_rows(spark, sf_dir):
    """Raw Parquet files to processed Parquet files."""
    raw, processed = scratch_path(spark, "raw"), scratch_path(spark, "processed")
    raw_energy(spark, sf_dir).write.parquet(raw)
    clean = clean_snapshot(spark, raw, processed)
    return clean.select("source_row_id", *[c for c in clean.columns if c != "source_row_id"])


@query(
    "report_files",
    f"""with {SCORES_SQL}, {KINDS}, {BEST}, {METRICS} select model, {", ".join(f'"{m}"' for m in REPORTED)} from metrics where anomaly_type = '{OVERALL}'""",
)
def report_files(spark, sf_dir):
    """Metrics of stored scores as one JSON array of nested results, read back, flattened, written and read as CSV."""
    array, flat = scratch_path(spark, "results"), scratch_path(spark, "report")
    metrics = curve_metrics(score_curve(order_scores(spark, sf_dir), ()), ())
    nested = metrics.select("model", F.struct(*[r6(m) for m in REPORTED], r6("threshold")).alias("test_metrics"))
    texts = as_json(nested).agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("json")), ",\n"), F.lit("]")))
    texts.write.text(array)  # one row per model
    write_csv(comparison(read_results(spark, array)), flat)
    kinds = "model string, " + ", ".join(f"{m} double" for m in (*REPORTED, "training_seconds", "inference_seconds"))
    return spark.read.schema(kinds).option("header", True).csv(flat).select("model", *REPORTED)


# ---- digests ----

_DIGESTED = {
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_mktsegment", "c_nationkey"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
}


def _digest_sql(name: str) -> str:
    columns = sorted(_DIGESTED[name])
    struct = ", ".join(f"'{c}': {c}" for c in columns)
    sums = " || '|' || ".join(f"cast(sum(cast(('0x' || substr(h, {16 * i + 1}, 16)) as ubigint)) % 18446744073709551616 as varchar)" for i in range(4))
    kinds = " || ',' || ".join(f"'{c} ' || (select any_value(lower(typeof({c}))) from {name})" for c in columns)
    return f"""select '{name}' as name, count(*) as "rows", sha256(replace(replace({kinds}, 'varchar', 'string'), 'integer', 'int') || '|' || cast(count(*) as varchar) || '|' || {sums}) as digest
 from (select sha256(cast(to_json({{{struct}}}) as varchar)) as h from {name}) t"""


@query("table_digests", " union all ".join(_digest_sql(n) for n in _DIGESTED))
def table_digests(spark, sf_dir):
    """Digest observed while a table is written, and that of the same rows in other files and another order."""
    found = []
    for name, columns in _DIGESTED.items():
        rows = table(spark, sf_dir, name).select(*columns)
        item = publish(rows, scratch_path(spark, f"digest-{name}"))
        other = scratch_path(spark, f"digest-other-{name}")
        rows.repartition(7).sortWithinPartitions(F.desc(columns[0])).write.parquet(other)
        if table_digest(spark.read.parquet(other)) != item.sha256:
            raise RuntimeError(f"the digest of {name} follows its layout")
        found.append((name, item.row_count, item.sha256))
    return spark.createDataFrame(found, "name string, rows long, digest string")
