"""Queries over sources, cleaning and validity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsift.functions.keys import is_version, natural_id, sorted_json, version_from_timestamp, version_of, weights_from_json
from wattsift.functions.numbers import parse_number
from wattsift.functions.shares import rescale_to_hundred
from wattsift.operators.clean import (
    add_engineered,
    add_occupation,
    add_validity_flags,
    clean_table,
    coerce_numbers,
    drop_pooled_years,
    quoted,
    rename_percent_columns,
    select_features,
)
from wattsift.operators.inject import context_of, usable_mix, usable_split
from wattsift.plans.catalog import query
from wattsift.plans.energy_view import raw_energy, table
from wattsift.plans.oracle_parts import ADJUSTED, BRUT, CLEAN, CONTEXT, P, RAW, number, total, usable
from wattsift.plans.shared import r6
from wattsift.session import scratch_path
from wattsift.sources.csv_locale import assign_row_ids, scan_locale_csv
from wattsift.sources.reports import RESULT_SCHEMA, comparison, write_results
from wattsift.streaming.incremental import clean_stream, new_versions, read_versions, run_available, versions_in

_ALL = ("source_row_id", P.year, P.occupation, *P.context[:2], *P.numeric, P.mono_flag, *P.derived)


@query(
    "context_summary",
    f"""with {CLEAN} select {CONTEXT} as context, count(*) as n, cast(sum(case when {P.shares_valid} then 1 else 0 end) as bigint) as valid_mix,
 cast(sum(case when {P.splits_valid} then 1 else 0 end) as bigint) as valid_split, round(avg({ADJUSTED}), 6) as mean_ratio,
 round(avg({P.delta}), 6) as mean_delta, round(stddev_pop({BRUT}), 6) as spread from clean group by 1""",
)
def context_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        clean_table(raw_energy(spark, sf_dir))
        .groupBy(context_of().alias("context"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(P.shares_valid)).alias("valid_mix"),
            F.count_if(F.col(P.splits_valid)).alias("valid_split"),
            r6("mean_ratio", F.avg(ADJUSTED)),
            r6("mean_delta", F.avg(P.delta)),
            r6("spread", F.stddev_pop(BRUT)),
        )
    )


@query("clean_filter_years", f"with {RAW} select source_row_id, {P.year} from raw where {P.year} is distinct from '2010-2019'")
def clean_filter_years(spark, sf_dir):
    return drop_pooled_years(raw_energy(spark, sf_dir)).select("source_row_id", P.year)


@query(
    "clean_rename_percent",
    f"""with {RAW} select source_row_id, {", ".join(f'"{c[:-4]}_%" as {c}' for c in P.splits + P.shares)} from raw""",
)
def clean_rename_percent(spark, sf_dir):
    return rename_percent_columns(raw_energy(spark, sf_dir)).select("source_row_id", *P.splits, *P.shares)


@query("clean_numeric_coerce", f"with {CLEAN} select source_row_id, {', '.join(P.numeric)} from clean")
def clean_numeric_coerce(spark, sf_dir):
    raw = drop_pooled_years(raw_energy(spark, sf_dir))
    return coerce_numbers(rename_percent_columns(raw)).select("source_row_id", *P.numeric)


_FORMS = (
    "cast(o_totalprice as varchar(30))", "concat(' ', cast(o_custkey as varchar(30)), ' ')",
    "concat(cast(o_custkey as varchar(30)), ',5')", "concat(cast(o_custkey as varchar(30)), 'e3')",
    "concat(cast(o_custkey as varchar(30)), '.5d')", "concat('0x', cast(o_custkey as varchar(30)))",
    "concat('1_', cast(o_custkey as varchar(30)))", "'inf'", "''", "'n/c'", "cast(null as varchar(30))",
    "concat('-.', cast(o_custkey as varchar(30)))",
)
_FORM_SQL = "case o_orderkey % 12 " + " ".join(f"when {i} then {f}" for i, f in enumerate(_FORMS)) + " end"


@query(
    "parse_numbers",
    f"with t as (select o_orderkey, {_FORM_SQL} as txt from orders) select o_orderkey, {number('txt')} as value from t",
)
def parse_numbers(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_FORM_SQL} as txt")
    return texts.select("o_orderkey", parse_number(F.col("txt")).alias("value"))


@query("clean_flags", f"with {CLEAN} select source_row_id, {P.shares_valid}, {P.splits_valid} from clean")
def clean_flags(spark, sf_dir):
    raw = rename_percent_columns(drop_pooled_years(raw_energy(spark, sf_dir)))
    return add_validity_flags(coerce_numbers(raw)).select("source_row_id", P.shares_valid, P.splits_valid)


@query("clean_features", f"with {CLEAN} select source_row_id, {P.mono_flag}, {P.delta}, {P.shares_sum}, {P.splits_sum} from clean")
def clean_features(spark, sf_dir):
    raw = coerce_numbers(rename_percent_columns(drop_pooled_years(raw_energy(spark, sf_dir))))
    return add_engineered(add_occupation(raw)).select("source_row_id", P.mono_flag, P.delta, P.shares_sum, P.splits_sum)


@query("clean_all", f"with {CLEAN} select {', '.join(_ALL)} from clean")
def clean_all(spark, sf_dir):
    return clean_table(raw_energy(spark, sf_dir)).select(*_ALL)


@query("feature_contract", f"with {CLEAN} select {', '.join(P.features)} from clean")
def feature_contract(spark, sf_dir):
    return select_features(clean_table(raw_energy(spark, sf_dir)))


@query(
    "donor_valid_rows",
    f"with {CLEAN} select source_row_id, {usable(P.shares)} as usable_mix, {usable(P.splits)} as usable_split from clean",
)
def donor_valid_rows(spark, sf_dir):
    return clean_table(raw_energy(spark, sf_dir)).select(
        "source_row_id", usable_mix().alias("usable_mix"), usable_split().alias("usable_split")
    )


def _floored(columns):
    return tuple(f"greatest(coalesce({c}, 0), 0)" for c in columns)


@query(
    "normalise_shares",
    f"""with {CLEAN}, shifted as (select source_row_id, {", ".join(f"{c} - 1 as {c}" for c in P.shares)} from clean)
 select source_row_id, {", ".join(f"round(case when {total(_floored(P.shares))} <= 0 then cast({100 if i == 0 else 0} as double) else {f} * (cast(100 as double) / {total(_floored(P.shares))}) end, 6) as {c}" for i, (c, f) in enumerate(zip(P.shares, _floored(P.shares), strict=True)))} from shifted""",
)
def normalise_shares(spark, sf_dir):
    """Shares shifted below zero first, so that clipping and renormalising both matter."""
    clean = clean_table(raw_energy(spark, sf_dir))
    scaled = clean.select("source_row_id", rescale_to_hundred(F.array(*[F.col(c) - 1 for c in P.shares])).alias("s"))
    return scaled.select("source_row_id", *[r6(c, F.col("s")[i]) for i, c in enumerate(P.shares)])


@query(
    "csv_locale_scan",
    f"""with {RAW} select row_number() over (order by source_row_id) - 1 as source_row_id, source_row_id as original_id, {P.year},
 cast(source_row_id as double) / 8 as eighth, {ADJUSTED} as mixed_text, "consommation_espaces_communs_%" as spaces from raw""",
)
def csv_locale_scan(spark, sf_dir):
    """Raw rows written as semicolon text with decimal commas, read back with inferred types and dense ids."""
    path = scratch_path(spark, "csv")
    raw = raw_energy(spark, sf_dir)
    comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
    raw.repartitionByRange("source_row_id").sortWithinPartitions("source_row_id").select(
        F.col("source_row_id").alias("original_id"),
        P.year,
        comma(F.col("source_row_id") / 8.0).alias("eighth"),
        F.col(ADJUSTED).alias("mixed_text"),
        comma(quoted("consommation_espaces_communs_%")).alias("spaces"),
    ).write.option("header", True).option("sep", ";").csv(path)
    types = {"original_id": "long", P.year: "string", "eighth": "double", "mixed_text": "string", "spaces": "double"}
    return scan_locale_csv(spark, path, types=types, row_id="source_row_id")


@query(
    "csv_inferred_types",
    f"""with {RAW}, t as (select cast(count(*) as bigint) as n from raw)
 select 'eighth' as column_name, 'double' as kind, n from t union all select '{P.year}', 'string', n from t
 union all select 'mixed_text', 'string', n from t union all select 'original_id', 'long', n from t
 union all select 'spaces', 'double', n from t""",
)
def csv_inferred_types(spark, sf_dir):
    """Types found by the inference pass; a year column with a pooled range and a number column with n/c stay text."""
    path = scratch_path(spark, "csv")
    comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
    raw_energy(spark, sf_dir).select(
        F.col("source_row_id").alias("original_id"),
        P.year,
        comma(F.col("source_row_id") / 8.0).alias("eighth"),
        F.col(ADJUSTED).alias("mixed_text"),
        comma(quoted("consommation_espaces_communs_%")).alias("spaces"),
    ).write.option("header", True).option("sep", ";").csv(path)
    scanned = scan_locale_csv(spark, path)
    names = {"bigint": "long"}
    kinds = [(f.name, names.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in scanned.schema.fields]
    rows = scanned.groupBy().agg(F.count(F.lit(1)).alias("n"))
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind")) for c, k in kinds])
    return rows.select("n", F.explode(cells).alias("e")).select("e.column_name", "e.kind", "n")


@query(
    "csv_quoted_breaks",
    r"""select row_number() over (order by event_id) - 1 as row_id, event_id, cast(user_id as double) / 8 as eighth,
 concat(event_type, E'\n', props, E'\n\n;"', cast(user_id as varchar)) as note from events""",
)
def csv_quoted_breaks(spark, sf_dir):
    """Events written as text with line breaks, separators and quotes inside fields, read back with ids in file order."""
    path = scratch_path(spark, "csv-breaks")
    note = F.concat("event_type", F.lit("\n"), "props", F.lit('\n\n;"'), F.col("user_id").cast("string"))
    eighth = F.replace((F.col("user_id") / 8.0).cast("string"), F.lit("."), F.lit(","))
    rows = table(spark, sf_dir, "events").repartitionByRange("event_id").sortWithinPartitions("event_id")
    rows = rows.select("event_id", eighth.alias("eighth"), note.alias("note"))
    rows.write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    types = {"event_id": "long", "eighth": "double", "note": "string"}
    return scan_locale_csv(spark, path, types=types, row_id="row_id", multiline=True)


@query(
    "dense_row_id",
    "select row_number() over (order by o_totalprice, o_orderkey) - 1 as source_row_id, o_orderkey, o_totalprice from orders",
)
def dense_row_id(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").repartitionByRange(8, "o_totalprice", "o_orderkey")
    return assign_row_ids(ordered.sortWithinPartitions("o_totalprice", "o_orderkey"))


_KEY = "concat('raw/', event_type, '/version=', substr(cast(ts as varchar(30)), 1, 10), '/part-', cast(event_id as varchar(20)))"


@query(
    "version_extract",
    f"""select event_id, regexp_extract({_KEY}, 'version=([^/]*)', 1) as version, substr(cast(ts as varchar), 1, 10) as stamp_version,
 regexp_full_match(regexp_extract({_KEY}, 'version=([^/]*)', 1), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') as well_formed from events""",
)
def version_extract(spark, sf_dir):
    keyed = table(spark, sf_dir, "events").selectExpr("event_id", "cast(ts as string) as stamp", f"{_KEY} as object_key")
    version = version_of(F.col("object_key"))
    return keyed.select(
        "event_id",
        version.alias("version"),
        version_from_timestamp(F.col("stamp")).alias("stamp_version"),
        is_version(version).alias("well_formed"),
    )


@query(
    "new_versions",
    f"""select distinct substr(cast(ts as varchar), 1, 10) as version from events where substr(cast(ts as varchar), 1, 10) not in
 (select substr(cast(ts as varchar), 1, 10) from events group by 1 having sum(value) > (select sum(value) / count(distinct substr(cast(ts as varchar), 1, 10)) from events))""",
)
def new_version_rows(spark, sf_dir):
    """Days are versions; days with more than the average total count as processed."""
    keyed = table(spark, sf_dir, "events").selectExpr(f"{_KEY} as object_key", "value")
    per_day = keyed.groupBy(version_of(F.col("object_key")).alias("version")).agg(F.sum("value").alias("v"))
    average = per_day.agg(F.avg("v")).first()[0]
    return new_versions(versions_in(keyed), per_day.filter(F.col("v") > average))


@query(
    "json_flatten",
    """select concat(l_returnflag, l_linestatus) as model, round(avg(l_discount), 6) as pr_auc, round(avg(l_tax), 6) as roc_auc,
 round(min(l_discount), 6) as "precision", round(max(l_discount), 6) as recall, round(max(l_tax), 6) as f1,
 round(avg(l_quantity), 6) as training_seconds, round(avg(l_linenumber), 6) as inference_seconds from lineitem group by 1""",
)
def json_flatten(spark, sf_dir):
    """Nested JSON results, one object per line group, flattened to the comparison table."""
    metrics = F.struct(
        r6("pr_auc", F.avg("l_discount")), r6("roc_auc", F.avg("l_tax")), r6("precision", F.min("l_discount")),
        r6("recall", F.max("l_discount")), r6("f1", F.max("l_tax")),
    )
    clock = F.struct(r6("training_seconds", F.avg("l_quantity")), r6("inference_seconds", F.avg("l_linenumber")))
    lines = table(spark, sf_dir, "lineitem")
    nested = lines.groupBy(F.concat("l_returnflag", "l_linestatus").alias("model")).agg(
        metrics.alias("test_metrics"), clock.alias("configuration")
    )
    path = scratch_path(spark, "results")
    write_results(nested.repartition("model"), path)
    return comparison(spark.read.schema(RESULT_SCHEMA).json(path))


@query(
    "weights_json",
    """select event_id, concat('{"', event_type, '":', cast(value as varchar), ',"zz":1.0}') as weights,
 value + 1 as total from events""",
)
def weights_json(spark, sf_dir):
    """Type weights read from a JSON object and written back with keys in order."""
    texts = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('{\"zz\":1.0,\"', event_type, '\":', cast(value as string), '}') as txt"
    )
    parsed = texts.withColumn("w", weights_from_json(F.col("txt")))
    total_weight = F.aggregate(F.map_values("w"), F.lit(0.0), lambda acc, x: acc + x)
    return parsed.select("event_id", sorted_json(F.col("w")).alias("weights"), total_weight.alias("total"))


@query(
    "natural_ids",
    """select event_id, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) as id, h as digest
 from (select event_id, sha256(concat_ws(chr(31), event_type, cast(event_id as varchar))) as h from events) t""",
)
def natural_ids(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parts = (F.col("event_type"), F.col("event_id"))
    return events.select(
        "event_id",
        natural_id(*parts).alias("id"),
        F.sha2(F.concat_ws("\u001f", "event_type", F.col("event_id").cast("string")), 256).alias("digest"),
    )


@query("stream_clean", f"with {CLEAN} select {', '.join(_ALL)}, case when {P.mono_flag} then 'a' else 'b' end as version from clean")
def stream_clean(spark, sf_dir):
    """Raw versions arriving as folders, cleaned by a stream that remembers what it has seen."""
    root, out, seen = (scratch_path(spark, x) for x in ("stream-raw", "stream-out", "stream-seen"))
    raw = raw_energy(spark, sf_dir).withColumn("version", F.when(F.col(P.occupation) == "1A", "a").otherwise("b"))
    schema = raw.schema
    for version in ("a", "b"):
        raw.filter(F.col("version") == version).drop("version").write.parquet(f"{root}/version={version}")
        run_available(clean_stream(read_versions(spark, root, schema)), out, seen)
    return spark.read.parquet(out).select(*_ALL, "version")
