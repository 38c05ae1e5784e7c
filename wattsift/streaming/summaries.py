"""Fits that follow new versions: each version is summarised once, and summaries are added up.

A summary has, per number, its counts, moments and a quantile sketch, and per category its count.  All but the median
follow from summaries alone.  The merged sketch names a narrow bracket for each median, which one counting pass over the
numeric columns verifies, so that a fit equals one from scratch.

A version's categories are written before its numbers; only versions whose numbers are there count, so an attempt that
broke off in between is simply repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsift.operators.clean import require_columns
from wattsift.operators.order_stats import DIRECT_ROWS, values_at_ranks
from wattsift.operators.prep import Preprocessor, as_number, category_counts, preprocessor_of, stats_line
from wattsift.profile import ENERGY, Profile
from wattsift.session import materialise
from wattsift.sources.snapshots import read_version

SKETCH_SIZE = 4_096  # a rank is then off by less than one in a thousand, nearly always
BRACKET = 0.003

_NUMBERS = "feature string, rows long, known long, mean double, spread double, sketch binary, version string"
_CATEGORIES = "feature string, value string, n long, version string"


def number_summary(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """One row per numeric feature: rows, known values, their mean, summed squared deviations and sketch; one pass."""
    parts: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(profile.numeric):
        v = as_number(df, name)
        parts += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}"), F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE)).alias(f"s{i}")]
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"), F.col(f"n{i}").alias("known"), F.coalesce(f"m{i}", F.lit(0.0)).alias("mean"),
                F.coalesce(F.col(f"v{i}") * F.col(f"n{i}"), F.lit(0.0)).alias("spread"), F.col(f"s{i}").alias("sketch"),
            )
            for i, name in enumerate(profile.numeric)
        ]
    )
    return df.agg(*parts).select("rows", F.explode(lines).alias("e")).select("e.feature", "rows", "e.known", "e.mean", "e.spread", "e.sketch")


def summarise(df: DataFrame, store: str, version: str, profile: Profile = ENERGY) -> None:
    """Write the summary of one version's rows."""
    require_columns(df, profile.features, "Dataset is missing configured features")
    category_counts(df, profile.categoricals, profile).write.mode("overwrite").parquet(f"{store}/categories/version={version}")
    number_summary(df, profile).coalesce(1).write.mode("errorifexists").parquet(f"{store}/numbers/version={version}")


def read_numbers(spark: SparkSession, store: str) -> DataFrame:
    """Summaries of numbers by version; none if the store is new."""
    spark.createDataFrame([], _NUMBERS).drop("version").write.mode("ignore").parquet(f"{store}/numbers/version=none")
    return spark.read.schema(_NUMBERS).option("basePath", f"{store}/numbers").parquet(f"{store}/numbers")


def read_categories(spark: SparkSession, store: str) -> DataFrame:
    whole = read_numbers(spark, store).select("version").distinct()
    found = spark.read.schema(_CATEGORIES).option("basePath", f"{store}/categories").parquet(f"{store}/categories")
    return found.join(F.broadcast(whole), "version", "left_semi")  # one row per version


def update_summaries(spark: SparkSession, root: str, store: str, profile: Profile = ENERGY) -> list[str]:
    """Summarise the ``version=`` folders under ``root`` that have no summary yet, and name them.

    Versions are found by the partition column alone, so no column of a summarised version is read.
    """
    found = spark.read.option("basePath", root).parquet(root).select(F.col("version").cast("string")).distinct()
    fresh = found.join(read_numbers(spark, store).select("version").distinct(), "version", "left_anti")
    names = sorted(r["version"] for r in fresh.collect())
    for version in names:
        summarise(read_version(spark, root, version).drop("version"), store, version, profile)
    return names


def merged_numbers(spark: SparkSession, store: str) -> DataFrame:
    """(feature, rows, known, mean, spread, low, high) over all versions; the last two bracket the median."""
    parts = read_numbers(spark, store)
    means = parts.groupBy("feature").agg(F.try_divide(F.sum(F.col("mean") * F.col("known")), F.sum("known")).alias("whole"))
    apart = F.col("mean") - F.col("whole")
    merged = parts.join(F.broadcast(means), "feature").groupBy("feature").agg(
        F.sum("rows").alias("rows"), F.sum("known").alias("known"), F.first("whole").alias("mean"),
        F.sum(F.col("spread") + F.when(F.col("known") > 0, F.col("known") * apart * apart).otherwise(0.0)).alias("spread"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    mark = lambda share: F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))
    return merged.select("feature", "rows", "known", "mean", "spread", mark(0.5 - BRACKET).alias("low"), mark(0.5 + BRACKET).alias("high"))


def fit_summarised(rows: DataFrame, store: str, profile: Profile = ENERGY, direct_rows: int = DIRECT_ROWS) -> Preprocessor:
    """The preparation fitted on all summarised versions; ``rows`` are theirs, read for the medians only."""
    spark = rows.sparkSession
    lines = {r["feature"]: r for r in merged_numbers(spark, store).collect()}  # one row per feature
    total = max((r["rows"] for r in lines.values()), default=0)
    if not total:
        raise ValueError("There are no summarised rows.")
    values = {c: as_number(rows, c) for c in profile.numeric if lines[c]["known"]}
    middle = {c: sorted({(lines[c]["known"] + 1) // 2, lines[c]["known"] // 2 + 1}) for c in values}
    guesses = {(c, r): (lines[c]["low"], lines[c]["high"]) for c in values for r in middle[c]}
    hits = values_at_ranks(rows, values, middle, {c: lines[c]["known"] for c in values}, guesses, direct_rows)
    numbers = []
    for name in profile.numeric:
        r = lines[name]
        fill = sum(float(hits[(name, k)].value) for k in middle[name]) / len(middle[name]) if r["known"] else 0.0
        numbers.append(stats_line(name, fill, r["rows"], r["known"], r["mean"], r["spread"] / r["known"] if r["known"] else None))
    counts = read_categories(spark, store).groupBy("feature", "value").agg(F.sum("n").alias("n"))
    return preprocessor_of(materialise(counts, "category-counts"), numbers, profile)
