"""Cleaning, validity flags and engineered columns.  Everything here is row-local: one stage, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattsift.functions.numbers import nan_to_null, parse_number, row_sum
from wattsift.functions.shares import sums_to_hundred
from wattsift.profile import ENERGY, LABEL_COLUMNS, Profile


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(df: DataFrame, needed: Iterable[str], message: str) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{message}: {missing}")


def require_labels(df: DataFrame) -> None:
    require_columns(df, LABEL_COLUMNS[:2], "Evaluation dataset is missing labels")


def drop_pooled_years(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """Drop rows that pool several years; rows without a year stay."""
    return df.filter(~F.col(profile.year).eqNullSafe(profile.pooled_years))


def rename_percent_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.replace("_%", "_pct") for c in df.columns if "_%" in c})


def coerce_numbers(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """Configured numeric columns to double, unreadable text to null; absent columns are skipped."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def as_double(name: str) -> Column:
        kind = types[name]
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return nan_to_null(F.col(name).cast("double"))
        if isinstance(kind, T.StringType):
            return parse_number(F.col(name))
        return F.col(name).cast("double")

    return df.withColumns({c: as_double(c) for c in profile.numeric if c in types})


def add_validity_flags(df: DataFrame, profile: Profile = ENERGY, tolerance: float = 0.1) -> DataFrame:
    return df.withColumns(
        {
            profile.shares_valid: sums_to_hundred([F.col(c) for c in profile.shares], tolerance),
            profile.splits_valid: sums_to_hundred([F.col(c) for c in profile.splits], tolerance),
        }
    )


def add_occupation(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    return df.withColumn(profile.mono_flag, F.col(profile.occupation).eqNullSafe(profile.mono_code))


def add_engineered(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """Ratio difference and both composition sums, each only where its inputs exist."""
    added: dict[str, Column] = {}
    adjusted, raw = profile.ratios
    if adjusted in df.columns and raw in df.columns:
        added[profile.delta] = F.col(adjusted) - F.col(raw)
    for target, members in ((profile.shares_sum, profile.shares), (profile.splits_sum, profile.splits)):
        present = [F.col(c) for c in members if c in df.columns]
        if present:
            added[target] = row_sum(present)
    return df.withColumns(added) if added else df


def clean_table(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """Raw snapshot to processed table."""
    return (
        df.transform(drop_pooled_years, profile)
        .transform(rename_percent_columns)
        .transform(coerce_numbers, profile)
        .transform(add_validity_flags, profile)
        .transform(add_occupation, profile)
        .transform(add_engineered, profile)
    )


def recompute_derived(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """The five derived columns, from the current values."""
    return df.transform(add_validity_flags, profile).transform(add_engineered, profile)


def select_features(df: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """Feature contract: fail on a missing feature, project in fixed order."""
    require_columns(df, profile.features, "Dataset is missing configured features")
    return df.select(*profile.features)
