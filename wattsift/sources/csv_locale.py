"""Delimited text with a decimal comma, and dense row ids in file order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattsift.operators.clean import quoted
from wattsift.operators.sample import BROADCAST_ROWS
from wattsift.session import materialise
from wattsift.sources.quoted_csv import read_quoted_csv

# ---- fixed values: text read as missing ----
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

INTEGER_PATTERN = r"^[+-]?[0-9]{1,18}$"


def _number_pattern(decimal: str) -> str:
    return rf"^[+-]?([0-9]+[{decimal}]?[0-9]*|[{decimal}][0-9]+)([eE][+-]?[0-9]+)?$"


def _known(name: str) -> Column:
    return F.when(~quoted(name).isin(*NULL_TOKENS), quoted(name)).alias(name)


def read_text_columns(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Every column as text, missing tokens as null."""
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    return raw.select(
        *[_known(c) for c in raw.columns],
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__place"),
    )


def infer_types(text: DataFrame, decimal: str = ",") -> dict[str, str]:
    """Column types from one pass: bool or long only without nulls, double when every value is a number."""
    names = [c for c in text.columns if not c.startswith("__")]
    checks = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(names):
        v = F.trim(quoted(c))
        checks += [
            F.count(v).alias(f"n{i}"),
            F.count_if(v.rlike(INTEGER_PATTERN)).alias(f"i{i}"),
            F.count_if(v.rlike(_number_pattern(decimal))).alias(f"d{i}"),
            F.count_if(v.isin("True", "False", "TRUE", "FALSE", "true", "false")).alias(f"b{i}"),
        ]
    row = text.agg(*checks).first()
    types = {}
    for i, c in enumerate(names):
        known, complete = row[f"n{i}"], row[f"n{i}"] == row["rows"]
        if known and complete and row[f"b{i}"] == known:
            types[c] = "boolean"
        elif known and complete and row[f"i{i}"] == known:
            types[c] = "long"
        else:
            types[c] = "double" if row[f"d{i}"] == known else "string"
    return types


def _typed(name: str, kind: str, decimal: str) -> Column:
    text = F.trim(quoted(name))
    if kind == "double":
        number = F.replace(text, F.lit(decimal), F.lit(".")).try_cast("double")
        return F.when(text.rlike(_number_pattern(decimal)), number)
    if kind in ("long", "boolean"):
        return text.try_cast(kind)
    return quoted(name)


def scan_locale_csv(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    decimal: str = ",",
    types: Mapping[str, str] | None = None,
    row_id: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Typed table; ``types`` skips the inference pass, ``row_id`` adds dense ids from 0 in file order first.

    ``multiline`` allows line breaks in quoted fields, whose quotes are doubled; a file is still read by many tasks.
    """
    if multiline:
        text = read_quoted_csv(spark, path, sep)
        text = text.select(*[_known(c) for c in text.columns if c != "__id"], "__id")
    else:
        _pin_splits(spark)
        text = read_text_columns(spark, path, sep)
    kinds = dict(types) if types is not None else infer_types(text, decimal)
    names = [c for c in text.columns if not c.startswith("__")]
    if row_id is not None and row_id in names:
        raise ValueError(f"Column already exists: {row_id}")
    columns = [_typed(c, kinds.get(c, "string"), decimal).alias(c) for c in names]
    if row_id is None:
        return text.select(*columns)
    if multiline:
        return text.select(F.col("__id").alias(row_id), *columns)
    return with_block_offsets(text).select((F.col("__first") + F.col("__place") - F.col("__start")).alias(row_id), *columns)


def _pin_splits(spark: SparkSession) -> None:
    """Keep file splits equal between the counting pass and the reading pass while executors come and go."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def _task() -> Column:
    """The task that gave a row its place."""
    return F.shiftright("__place", 33)


def with_block_offsets(text: DataFrame) -> DataFrame:
    """Adds, per file block, the id of its first row (``__first``) and its first place (``__start``).

    One row per input split is counted and summed in the order (file, block); rows never move.
    """
    blocks = materialise(
        text.groupBy("__file", "__block", _task().alias("__task")).agg(F.count(F.lit(1)).alias("rows"), F.min("__place").alias("__start")),
        "csv-blocks",
    )
    earlier = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "__file", "__block", "__task", "__start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("__first")
    )
    if blocks.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    joined = text.withColumn("__task", _task()).join(offsets, ["__file", "__block", "__task"], "left")
    lost = F.raise_error(F.lit("File splits changed between two passes over the same files."))
    return joined.withColumn("__first", F.coalesce(F.col("__first"), lost.cast("long")))


def assign_row_ids(df: DataFrame, row_id: str = "source_row_id") -> DataFrame:
    """Dense ids from 0 for any table, in its current row order; the table is written once to fix that order."""
    if row_id in df.columns:
        raise ValueError(f"Column already exists: {row_id}")
    fixed = materialise(
        df.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}), "row-ids"
    )
    parts = fixed.groupBy("__part").agg(F.count(F.lit(1)).alias("rows"), F.min("__place").alias("__start"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per written task
    offsets = parts.select("__part", "__start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("__first"))
    return fixed.join(F.broadcast(offsets), "__part").select(
        (F.col("__first") + F.col("__place") - F.col("__start")).alias(row_id), *[quoted(c) for c in df.columns]
    )
