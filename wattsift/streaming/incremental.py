"""Incremental work: process every source version once, score arriving records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattsift.functions.keys import is_version, version_of
from wattsift.operators.clean import clean_table
from wattsift.operators.forest import Forest
from wattsift.operators.models import predict
from wattsift.operators.prep import Preprocessor
from wattsift.profile import ENERGY, Profile


def versions_in(paths: DataFrame, column: str = "object_key") -> DataFrame:
    """Distinct well-formed versions named in object keys."""
    found = paths.filter(F.col(column).contains("version=")).select(version_of(F.col(column), strict=False).alias("version"))
    return found.filter(is_version(F.col("version"))).distinct()


def new_versions(found: DataFrame, processed: DataFrame) -> DataFrame:
    """Versions that no finished run has recorded yet."""
    return found.join(processed.select("version").distinct(), "version", "left_anti")


def read_versions(spark: SparkSession, root: str, schema: T.StructType, per_trigger: int | None = None) -> DataFrame:
    """Stream of the rows of all ``version=`` folders; folders that appear later are picked up once."""
    reader = spark.readStream.schema(schema).option("basePath", root)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(root)


def run_available(rows: DataFrame, out: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append everything that is new since the last run to Parquet, then stop; the checkpoint remembers progress."""
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def clean_stream(rows: DataFrame, profile: Profile = ENERGY) -> DataFrame:
    """The batch cleaning steps: all row-local, so no state is kept."""
    return clean_table(rows, profile)


def score_stream(rows: DataFrame, pre: Preprocessor, model: Forest, keep: tuple[str, ...], profile: Profile = ENERGY) -> DataFrame:
    """Predictions for arriving records; fitted tables are static lookups."""
    return predict(rows, pre, model, keep, profile=profile)


# ---- scores that are written once, whatever fails ----

LEDGER_SCHEMA = "query string, batch long, rows long, model_key string"


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """One row for each batch that is whole: (query, batch, rows, model_key)."""
    return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True).parquet(f"{out}/ledger")


def read_scores(spark: SparkSession, out: str) -> DataFrame:
    """Scores of whole batches only; what a failed batch left behind is not read."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(f"{out}/data")
    whole = read_ledger(spark, out).select("query", "batch").distinct()
    return rows.join(whole, ["query", "batch"], "left_semi")


def fresh_rows(rows: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """A stream without rows that repeat the keys of one seen at most ``delay`` earlier in event time; state older
    than that is given up, so it does not grow with the stream."""
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def score_once(
    rows: DataFrame, out: str, checkpoint: str, resolve: Callable[[], tuple[str, Preprocessor, Forest]],
    keep: tuple[str, ...], name: str = "scores", profile: Profile = ENERGY,
) -> StreamingQuery:
    """Score what is new since the last run, each arriving row once, then stop.

    ``resolve`` gives the model's key, preparation and forest, and is asked again for every batch, so a model that was
    registered meanwhile is used from the next batch on.  A batch has a folder of its own, which a repeated attempt
    replaces; its line in the ledger is written last.  A stream that is started again after a failure gets its last
    batch once more: if the ledger has it, nothing is done, and if not, it is written anew.
    """
    spark = rows.sparkSession
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(f"{out}/ledger/start")

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        mine = (F.col("query") == name) & (F.col("batch") == number)
        if not read_ledger(session, out).where(mine).isEmpty():
            return
        key, pre, model = resolve()
        scored = predict(batch, pre, model, keep, profile=profile)
        marked = scored.withColumns({"model_key": F.lit(key), "query": F.lit(name), "batch": F.lit(number).cast("long")})
        seen = Observation()
        place = f"query={name}-{number}"
        marked.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{out}/data/{place}")
        line = session.createDataFrame([(name, number, int(seen.get["rows"]), key)], LEDGER_SCHEMA)
        line.coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/{place}")

    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
