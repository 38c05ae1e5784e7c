"""Feature preparation: impute, frequency-encode, scale; fitted state is two small tables.

Fitting reads the table three times whatever the number of columns: one aggregate for counts, means
and variances of every number, one search for every median, one grouped count of every category.
Imputation changes mean and variance in a known way, so they are corrected from the null counts
instead of being measured again after filling.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattsift.functions.numbers import nan_to_null
from wattsift.operators.clean import require_columns
from wattsift.operators.order_stats import DIRECT_ROWS, exact_quantiles
from wattsift.profile import ENERGY, Profile
from wattsift.session import materialise

LITERAL_CATEGORIES = 200
BROADCAST_CATEGORIES = 1_000_000

STATS_SCHEMA = "feature string, kind string, fill_number double, fill_text string, mean double, scale double"
FREQUENCY_SCHEMA = "feature string, value string, frequency double"


@dataclass(frozen=True)
class Preprocessor:
    """``stats``: one row per feature.  ``frequencies``: one row per (feature, category)."""

    stats: DataFrame
    frequencies: DataFrame

    @property
    def features(self) -> list[str]:
        return [r["feature"] for r in self.stats.select("feature").collect()]


def as_category(df: DataFrame, name: str, profile: Profile) -> Column:
    """Categories are compared as text; the occupation flag may also arrive as 0/1."""
    kind = df.schema[name].dataType
    if name == profile.mono_flag and not isinstance(kind, T.StringType):
        return F.col(name).cast("boolean").cast("string")
    return F.col(name).cast("string")


def as_number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    value = F.col(name).try_cast("double") if isinstance(kind, T.StringType) else F.col(name).cast("double")
    return nan_to_null(value)


def category_counts(df: DataFrame, columns: tuple[str, ...], profile: Profile = ENERGY) -> DataFrame:
    """(feature, value, n) for every categorical column in one grouped count; null is a value."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), as_category(df, c, profile).alias("value")) for c in columns])
    return (
        df.select(F.explode(cells).alias("cell"))
        .select("cell.feature", "cell.value")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_modes(counts: DataFrame) -> DataFrame:
    """Most frequent non-null value per feature, the smallest on a tie."""
    return (
        counts.filter(F.col("value").isNotNull())
        .groupBy("feature")
        .agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("mode"))
    )


def category_frequencies(counts: DataFrame) -> DataFrame:
    """Relative frequency per category after nulls were filled with the mode."""
    filled = (
        counts.join(F.broadcast(category_modes(counts)), "feature", "left")
        .select("feature", F.coalesce("value", "mode").alias("value"), "n")
        .groupBy("feature", "value")
        .agg(F.sum("n").alias("n"))
    )
    return _with_share(filled, "frequency")


def _with_share(counts: DataFrame, name: str) -> DataFrame:
    """Adds each row's share of its feature's total; totals are one row per feature."""
    totals = counts.groupBy("feature").agg(F.sum("n").alias("__total"))
    return counts.join(F.broadcast(totals), "feature").select("feature", "value", *_others(counts), (F.col("n") / F.col("__total")).alias(name), "n")


def _others(counts: DataFrame) -> list[str]:
    return [c for c in counts.columns if c not in ("feature", "value", "n")]


def number_stats(
    df: DataFrame, columns: tuple[str, ...], direct_rows: int = DIRECT_ROWS
) -> list[tuple[str, float, float, float]]:
    """(feature, median, mean, population deviation) with nulls filled by the median."""
    values = {c: as_number(df, c) for c in columns}
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, v in enumerate(values.values()):
        parts += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}")]
    row = df.agg(*parts).first()
    known_counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    medians = exact_quantiles(df, values, [0.5], direct_rows, known_counts)
    fills = [medians[name][0] if row[f"n{i}"] else 0.0 for i, name in enumerate(columns)]
    return [stats_line(name, fills[i], row["rows"], row[f"n{i}"], row[f"m{i}"], row[f"v{i}"]) for i, name in enumerate(columns)]


def stats_line(name: str, fill: float, rows: int, known: int, mean: float | None, variance: float | None) -> tuple[str, float, float, float]:
    """Mean and population deviation after the nulls were filled, from those of the known values."""
    if not known:
        return name, fill, fill, 0.0
    missing, gap = rows - known, fill - mean
    spread = (variance * known + gap * gap * known * missing / rows) / rows
    return name, fill, mean + gap * missing / rows, max(spread, 0.0) ** 0.5


def safe_scale(deviation: float, mean: float) -> float:
    """A constant column is scaled by 1; rounding noise counts as constant."""
    return 1.0 if deviation <= 1e-14 * max(1.0, abs(mean)) else deviation


def fit_preprocessor(df: DataFrame, profile: Profile = ENERGY, direct_rows: int = DIRECT_ROWS) -> Preprocessor:
    require_columns(df, profile.features, "Dataset is missing configured features")
    counts = materialise(category_counts(df, profile.categoricals, profile), "category-counts")
    return preprocessor_of(counts, number_stats(df, profile.numeric, direct_rows), profile)


def preprocessor_of(counts: DataFrame, numbers: list[tuple[str, float, float, float]], profile: Profile = ENERGY) -> Preprocessor:
    """From stored (feature, value, n) of the categories and (feature, fill, mean, deviation) of the numbers."""
    spark = counts.sparkSession
    frequencies = materialise(category_frequencies(counts), "category-frequencies")
    spread = (
        _with_share(frequencies, "weight")
        .groupBy("feature")
        .agg(
            F.sum(F.col("weight") * F.col("frequency")).alias("mean"),
            F.sum(F.col("weight") * F.col("frequency") * F.col("frequency")).alias("square"),
        )
    )
    rows = category_modes(counts).join(spread, "feature", "right").collect()
    encoded = {r["feature"]: r for r in rows}
    stats = []
    for name in profile.categoricals:
        r = encoded[name]
        deviation = max(r["square"] - r["mean"] ** 2, 0.0) ** 0.5
        if r["square"] - r["mean"] ** 2 <= 1e-15:
            deviation = 0.0
        stats.append((name, "category", None, r["mode"], r["mean"], safe_scale(deviation, r["mean"])))
    for name, fill, mean, deviation in numbers:
        stats.append((name, "number", fill, None, mean, safe_scale(deviation, mean)))
    kept = spark.createDataFrame(stats, STATS_SCHEMA)
    return Preprocessor(kept, frequencies.select("feature", "value", "frequency"))


def encode_categories(
    df: DataFrame,
    pre: Preprocessor,
    profile: Profile = ENERGY,
    literal_rows: int = LITERAL_CATEGORIES,
    broadcast_rows: int = BROADCAST_CATEGORIES,
) -> DataFrame:
    """Each categorical column replaced by its frequency; unseen values become 0.

    A handful of categories becomes a constant map.  More are joined: broadcast while all frequency
    tables together are small, shuffled beyond that.
    """
    fills = {r["feature"]: r["fill_text"] for r in pre.stats.filter("kind = 'category'").collect()}
    few = pre.frequencies.limit(literal_rows + 1).collect()
    if len(few) <= literal_rows:
        coded = {}
        for name, fill in fills.items():
            key = F.coalesce(as_category(df, name, profile), F.lit(fill))
            pairs = [F.lit(x) for r in few if r["feature"] == name for x in (r["value"], r["frequency"]) if r["value"] is not None]
            coded[name] = F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(0.0)) if pairs else F.lit(0.0)
        return df.withColumns(coded)
    light = pre.frequencies.limit(broadcast_rows + 1).count() <= broadcast_rows
    for name, fill in fills.items():
        known = pre.frequencies.filter(F.col("feature") == name).select(
            F.col("value").alias("__value"), F.col("frequency").alias("__frequency")
        )
        if light:
            known = F.broadcast(known)
        filled = F.coalesce(as_category(df, name, profile), F.lit(fill))
        df = (
            df.withColumn("__key", filled)
            .join(known, F.col("__key") == F.col("__value"), "left")
            .withColumn(name, F.coalesce("__frequency", F.lit(0.0)))
            .drop("__key", "__value", "__frequency")
        )
    return df


def transform(df: DataFrame, pre: Preprocessor, profile: Profile = ENERGY) -> DataFrame:
    """Encoded, filled and scaled features in model order; other columns are kept as they are."""
    require_columns(df, profile.features, "Dataset is missing configured features")
    fitted = pre.stats.collect()
    coded = encode_categories(df, pre, profile)
    scaled = {}
    for r in fitted:
        name = r["feature"]
        value = F.col(name)
        if r["kind"] == "number":
            value = F.coalesce(as_number(df, name), F.lit(r["fill_number"]))
        scaled[name] = (value - F.lit(r["mean"])) / F.lit(r["scale"])
    return coded.withColumns(scaled)


def feature_vectors(df: DataFrame, pre: Preprocessor, keep: tuple[str, ...], profile: Profile = ENERGY) -> DataFrame:
    """``keep`` columns and the feature matrix row as array<double>."""
    kept = [c for c in keep if c not in profile.features]
    slim = df.select(*kept, *profile.features)
    return transform(slim, pre, profile).select(*kept, F.array(*profile.encoded).alias("features"))


def save_preprocessor(pre: Preprocessor, path: str) -> None:
    pre.stats.coalesce(1).write.mode("errorifexists").parquet(f"{path}/stats")
    pre.frequencies.write.mode("errorifexists").parquet(f"{path}/frequencies")


def load_preprocessor(spark: SparkSession, path: str) -> Preprocessor:
    return Preprocessor(
        spark.read.schema(STATS_SCHEMA).parquet(f"{path}/stats"),
        spark.read.schema(FREQUENCY_SCHEMA).parquet(f"{path}/frequencies"),
    )
