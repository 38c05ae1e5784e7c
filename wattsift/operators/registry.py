"""Runs, artifacts, datasets, models and experiments as append-only tables.

Keys that must be unique are claimed before their row is appended (``sources.claims``), so of writers that register
different things under one key exactly one succeeds.  Writers of the same thing may both append it; readers of
``Registry.table`` see one row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattsift.functions.keys import natural_id
from wattsift.session import materialise
from wattsift.sources.claims import claim
from wattsift.sources.snapshots import Published

SCHEMAS = {
    "pipeline_runs": "id string, status string, started_at timestamp, finished_at timestamp, "
    "configuration map<string,string>, error_message string, event_at timestamp",
    "artifacts": "id string, pipeline_run_id string, kind string, object_key string, content_type string, "
    "sha256 string, size_bytes long, metadata map<string,string>, created_at timestamp",
    "datasets": "id string, artifact_id string, name string, schema_version string, row_count long, "
    "source_dataset_id string",
    "models": "id string, artifact_id string, name string, version string, training_dataset_id string, "
    "parameters map<string,string>, metrics map<string,string>",
    "experiments": "id string, pipeline_run_id string, model_id string, evaluation_dataset_id string, "
    "configuration map<string,string>, metrics map<string,string>",
    "run_values": "run_id string, kind string, key string, value string",
}

# ---- fixed values: longest text each column may hold ----
LENGTHS = {
    ("pipeline_runs", "status"): 32,
    ("artifacts", "kind"): 32,
    ("artifacts", "object_key"): 512,
    ("artifacts", "content_type"): 128,
    ("artifacts", "sha256"): 64,
    ("datasets", "name"): 128,
    ("datasets", "schema_version"): 32,
    ("models", "name"): 128,
    ("models", "version"): 128,
}
UNIQUE = (
    ("pipeline_runs", "id"), ("artifacts", "id"), ("artifacts", "object_key"), ("datasets", "id"),
    ("datasets", "artifact_id"), ("models", "id"), ("models", "artifact_id"), ("experiments", "id"),
)
REFERENCES = (
    ("artifacts", "pipeline_run_id", "pipeline_runs"),
    ("datasets", "artifact_id", "artifacts"),
    ("datasets", "source_dataset_id", "datasets"),
    ("models", "artifact_id", "artifacts"),
    ("models", "training_dataset_id", "datasets"),
    ("experiments", "pipeline_run_id", "pipeline_runs"),
    ("experiments", "model_id", "models"),
    ("experiments", "evaluation_dataset_id", "datasets"),
)


# ---- what a row is known by; filters on these columns reach the scan ----
KNOWN_BY = {"artifacts": ("id", "object_key"), "datasets": ("id", "artifact_id"), "models": ("id", "artifact_id", "name", "version")}


# ---- set-based rules over given tables ----


def first_rows(name: str, rows: DataFrame) -> DataFrame:
    """One row of each id of a table with unique keys: the oldest, then the smallest."""
    if name not in KNOWN_BY:
        return rows
    keys = list(KNOWN_BY[name])
    rest = [c for c in rows.columns if c not in keys]
    order = F.to_json(F.struct(*sorted(rest, key=lambda c: c != "created_at")))
    folded = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("row"))
    return folded.select(*keys, "row.*").select(*rows.columns)


def current_runs(events: DataFrame) -> DataFrame:
    """Latest event per run; an end beats a start at the same instant."""
    fields = [c for c in events.columns if c != "id"]
    order = F.struct(F.col("event_at"), F.col("finished_at").isNotNull())
    return events.groupBy("id").agg(F.max_by(F.struct(*fields), order).alias("e")).select("id", "e.*")


def artifact_conflicts(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keys that would hold two digests: against the registry, or within the batch."""
    both = incoming.select("object_key", "sha256").unionByName(known.select("object_key", "sha256"))
    clash = both.groupBy("object_key").agg(F.min("sha256").alias("lowest"), F.max("sha256").alias("highest"))
    clash = clash.filter("lowest <> highest").select("object_key")
    return incoming.select("object_key").distinct().join(clash, "object_key", "left_semi")


def new_artifacts(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows whose key is not registered yet, one per key."""
    return incoming.join(known.select("object_key"), "object_key", "left_anti").dropDuplicates(["object_key"])


def dataset_conflicts(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Artifacts already registered as a dataset of another name or size."""
    old = known.select("artifact_id", F.col("name").alias("old_name"), F.col("row_count").alias("old_count"))
    differs = ~F.col("name").eqNullSafe(F.col("old_name")) | ~F.col("row_count").eqNullSafe(F.col("old_count"))
    return incoming.join(old, "artifact_id").filter(differs).select("artifact_id").distinct()


def new_datasets(known: DataFrame, incoming: DataFrame) -> DataFrame:
    return incoming.join(known.select("artifact_id"), "artifact_id", "left_anti").dropDuplicates(["artifact_id"])


def stored_datasets(datasets: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Dataset rows with the key they are stored under; a filter on the key reaches the artifact scan."""
    return datasets.join(artifacts.select(F.col("id").alias("artifact_id"), "object_key"), "artifact_id")


def resolve_models(models: DataFrame, artifacts: DataFrame, runs: DataFrame, per_version: bool = False) -> DataFrame:
    """Latest completed model per name (or per name and version) with its own and its preprocessor's key.

    Runs that never recorded an end come last; ``preprocessor_key`` is null where the run has none.
    """
    stored = artifacts.select(F.col("id").alias("artifact_id"), F.col("object_key").alias("model_key"), "pipeline_run_id")
    done = runs.filter(F.col("status") == "completed").select(F.col("id").alias("pipeline_run_id"), "finished_at")
    keys = ["name", "version"] if per_version else ["name"]
    order = F.struct(F.col("finished_at").isNull(), -F.unix_micros(F.col("finished_at").cast("timestamp")), F.col("id"))
    picked = (
        models.join(stored, "artifact_id")
        .join(done, "pipeline_run_id")
        .groupBy(*keys)
        .agg(F.min_by(F.struct("id", "version", "model_key", "pipeline_run_id"), order).alias("m"))
        .select("name", F.col("m.version").alias("version"), "m.model_key", "m.pipeline_run_id")
    )
    prepared = artifacts.filter(F.col("kind") == "preprocessor").groupBy("pipeline_run_id").agg(
        F.min("object_key").alias("preprocessor_key")
    )
    return picked.join(prepared, "pipeline_run_id", "left").select(
        "name", "version", "model_key", "preprocessor_key", "pipeline_run_id"
    )


def rule_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(relation, rule, violations) for uniqueness, references and text lengths; 0 everywhere when sound."""
    parts = []

    def add(relation: str, rule: str, broken: DataFrame) -> None:
        parts.append(
            broken.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(relation).alias("relation"), F.lit(rule).alias("rule"), "violations"
            )
        )

    for relation, column in UNIQUE:
        if relation in tables:
            filled = tables[relation].filter(F.col(column).isNotNull())
            add(relation, f"unique {column}", filled.groupBy(column).count().filter("count > 1"))
    for relation, column, target in REFERENCES:
        if relation in tables and target in tables:
            child = tables[relation].filter(F.col(column).isNotNull()).select(F.col(column).alias("ref"))
            parent = tables[target].select(F.col("id").alias("ref"))
            add(relation, f"reference {column}", child.join(parent, "ref", "left_anti"))
    for (relation, column), limit in LENGTHS.items():
        if relation in tables and column in tables[relation].columns:
            add(relation, f"length {column}", tables[relation].filter(F.length(column) > limit))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def lineage(datasets: DataFrame) -> DataFrame:
    """(id, root_id, depth): the first ancestor of every dataset.

    Pointers double each round, so a chain of length d takes log2(d) joins.
    """
    edges = datasets.select("id", F.col("source_dataset_id").alias("up"))
    state = edges.select("id", F.coalesce("up", "id").alias("up"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    state = materialise(state, "lineage")
    reached = state.agg(F.coalesce(F.sum("depth"), F.lit(0))).first()[0]
    for _ in range(40):
        # roots point at themselves with depth 0, so finished rows no longer change
        above = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        state = materialise(
            state.join(above, "up", "left").select(
                "id", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "lineage",
        )
        now = state.agg(F.coalesce(F.sum("depth"), F.lit(0))).first()[0]
        if now == reached:
            return state.select("id", F.col("up").alias("root_id"), "depth")
        reached = now
    raise ValueError("Dataset lineage has a cycle.")


def values_long(run_id: str, kind: str, wide: DataFrame) -> DataFrame:
    """Parameters or metrics of a run as (run_id, kind, key, value) rows."""
    text = wide.select([F.col(c).cast("string").alias(c) for c in wide.columns])
    return text.unpivot([], text.columns, "key", "value").select(F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"), "key", "value")


# ---- tables under one folder ----


@dataclass(frozen=True)
class Registry:
    spark: SparkSession
    root: str

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Registry:
        """Empty tables are written where none exist yet."""
        for name, schema in SCHEMAS.items():
            spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(f"{root}/{name}")
        return cls(spark, root)

    def table(self, name: str) -> DataFrame:
        return first_rows(name, self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}"))

    def claim(self, name: str, key: str, content: list) -> bool:
        """Whether the key is ours, or held by a writer of the same content."""
        text = json.dumps(content)
        return claim(self.spark, f"{self.root}/claims/{name}", key, text) == text

    def append(self, name: str, rows: DataFrame) -> None:
        columns = T.StructType.fromDDL(SCHEMAS[name]).names
        rows.select(*columns).write.mode("append").parquet(f"{self.root}/{name}")

    def runs(self) -> DataFrame:
        return current_runs(self.table("pipeline_runs"))

    def start_run(self, configuration: dict[str, str]) -> str:
        run_id = self.spark.range(1).select(F.uuid()).first()[0]
        row = self.spark.createDataFrame([(run_id, configuration)], "id string, configuration map<string,string>")
        now = F.current_timestamp()
        self.append(
            "pipeline_runs",
            row.select(
                "id", F.lit("running").alias("status"), now.alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"),
                "configuration", F.lit(None).cast("string").alias("error_message"), now.alias("event_at"),
            ),
        )
        return run_id

    def finish_run(self, run_id: str, error: str | None = None) -> None:
        now = F.current_timestamp()
        last = self.runs().filter(F.col("id") == run_id)
        status = "completed" if error is None else "failed"
        closed = last.withColumns(
            {"status": F.lit(status), "finished_at": now, "error_message": F.lit(error).cast("string"), "event_at": now}
        )
        # the event is read from the table it is appended to, so it is written from a copy
        self.append("pipeline_runs", materialise(closed, "run-event"))

    def register_artifact(self, run_id: str, item: Published, kind: str, metadata: dict[str, str] | None = None) -> str:
        """Id of the artifact; the old one when the key already holds the same content."""
        known = self.table("artifacts").filter(F.col("object_key") == item.object_key)
        old = known.select("id", "sha256").first()
        if old is not None:
            if old["sha256"] != item.sha256:
                raise ValueError(f"another content is registered under {item.object_key}")
            return old["id"]
        if not self.claim("artifacts", item.object_key, [item.sha256]):
            raise ValueError(f"another content is registered under {item.object_key}")
        row = self.spark.createDataFrame(
            [(run_id, kind, item.object_key, item.content_type, item.sha256, item.size_bytes, metadata or {})],
            "pipeline_run_id string, kind string, object_key string, content_type string, sha256 string, "
            "size_bytes long, metadata map<string,string>",
        )
        row = row.withColumns({"id": natural_id("artifact", F.col("object_key")), "created_at": F.current_timestamp()})
        self.append("artifacts", row)
        return row.first()["id"]

    def register_dataset(self, artifact_id: str, name: str, row_count: int, source: str | None = None, schema_version: str = "1") -> str:
        old = self.table("datasets").filter(F.col("artifact_id") == artifact_id).first()
        if old is not None:
            if old["name"] != name or old["row_count"] != row_count:
                raise ValueError(f"artifact {artifact_id} is a dataset of another name or size")
            return old["id"]
        if not self.claim("datasets", artifact_id, [name, row_count]):
            raise ValueError(f"artifact {artifact_id} is a dataset of another name or size")
        row = self.spark.createDataFrame(
            [(artifact_id, name, schema_version, row_count, source)],
            "artifact_id string, name string, schema_version string, row_count long, source_dataset_id string",
        ).withColumn("id", natural_id("dataset", F.col("artifact_id")))
        self.append("datasets", row)
        return row.first()["id"]

    def publish_dataset(self, run_id: str, item: Published, name: str, source: str | None = None) -> str:
        artifact = self.register_artifact(run_id, item, "dataset", {"columns": ",".join(item.columns)})
        return self.register_dataset(artifact, name, item.row_count, source)

    def register_model(
        self, artifact_id: str, name: str, version: str, training_dataset_id: str,
        parameters: dict[str, str], metrics: dict[str, str] | None = None,
    ) -> str:
        row = self.spark.createDataFrame(
            [(artifact_id, name, version, training_dataset_id, parameters, metrics or {})],
            "artifact_id string, name string, version string, training_dataset_id string, "
            "parameters map<string,string>, metrics map<string,string>",
        ).withColumn("id", natural_id("model", F.col("artifact_id"), F.col("name"), F.col("version")))
        known = self.table("models").filter(F.col("artifact_id") == artifact_id).select("name", "version", "id").first()
        if known is None and self.claim("models", artifact_id, [name, version]):
            self.append("models", row)
            return row.first()["id"]
        if known is None or (known["name"], known["version"]) != (name, version):
            raise ValueError(f"artifact {artifact_id} already holds a model of another name or version")
        return known["id"]

    def register_experiment(
        self, run_id: str, model_id: str | None, dataset_id: str | None, configuration: dict[str, str], metrics: dict[str, str]
    ) -> str:
        row = self.spark.createDataFrame(
            [(run_id, model_id, dataset_id, configuration, metrics)],
            "pipeline_run_id string, model_id string, evaluation_dataset_id string, "
            "configuration map<string,string>, metrics map<string,string>",
        ).withColumn("id", natural_id("experiment", F.col("pipeline_run_id"), F.coalesce("model_id", F.lit("")), F.coalesce("evaluation_dataset_id", F.lit("")), F.to_json(F.array_sort(F.map_entries("configuration")))))
        self.append("experiments", row)
        return row.first()["id"]

    def log_values(self, run_id: str, kind: str, wide: DataFrame) -> None:
        """Parameters or metrics of a run, one row per value."""
        self.append("run_values", values_long(run_id, kind, wide))

    def require_dataset(self, object_key: str) -> str:
        stored = stored_datasets(self.table("datasets"), self.table("artifacts"))
        row = stored.filter(F.col("object_key") == object_key).select("id").first()
        if row is None:
            raise LookupError(f"no dataset of the registry has the key {object_key}")
        return row["id"]

    def resolve(self, name: str, version: str | None = None) -> dict[str, str]:
        """Keys of the latest completed model, looked up afresh for every job."""
        models = self.table("models").filter(F.col("name") == name)
        if version is not None:
            models = models.filter(F.col("version") == version)
        row = resolve_models(models, self.table("artifacts"), self.runs()).first()
        if row is None:
            wanted = f"model {name!r}" + (f" version {version!r}" if version is not None else "")
            raise LookupError(f"no finished run has left {wanted}")
        if row["preprocessor_key"] is None:
            raise LookupError(f"run {row['pipeline_run_id']} has left no preprocessor")
        return row.asDict()
