"""Queries over runs, artifacts, datasets and models derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattsift.operators.registry import (
    artifact_conflicts,
    current_runs,
    dataset_conflicts,
    lineage,
    new_artifacts,
    new_datasets,
    resolve_models,
    rule_violations,
    stored_datasets,
    values_long,
)
from wattsift.plans.catalog import query
from wattsift.plans.energy_view import table
from wattsift.sources.snapshots import missing_keys

# Runs are orders (one start and one end event each), artifacts are events, one run per user.
_RUNS = """runs as (select concat('run-', cast(o_orderkey as varchar(20))) as id,
 case o_orderstatus when 'F' then 'completed' when 'O' then 'running' else 'failed' end as status,
 case when o_orderpriority = '5-LOW' then null else o_orderdate end as finished_at from orders)"""

_ARTIFACTS = """artifacts as (select concat('art-', cast(event_id as varchar(20))) as id, concat('run-', cast(user_id as varchar(20))) as pipeline_run_id,
 case event_type when 'signup' then 'preprocessor' when 'error' then 'dataset' else 'model' end as kind,
 concat('store/', event_type, '/', cast(event_id as varchar(20))) as object_key from events where event_type <> 'error' or value < 500)"""

_MODELS = """models as (select concat('mod-', cast(event_id as varchar(20))) as id, concat('art-', cast(event_id as varchar(20))) as artifact_id,
 concat('detector-', cast(user_id % 7 as varchar(20))) as name, substr(cast(ts as varchar(30)), 1, 10) as version from events
 where event_type in ('view', 'click', 'purchase'))"""


def _derived(spark, sf_dir, *parts: str):
    """The named relations as DataFrames, from the same text the oracles use."""
    sources = {"orders": table(spark, sf_dir, "orders"), "events": table(spark, sf_dir, "events")}
    result = []
    for part in parts:
        body = part.split(" as (", 1)[1][:-1]
        text = body.replace(" from orders", " from {orders}").replace(" from events", " from {events}")
        used = {k: v for k, v in sources.items() if "{" + k + "}" in text}
        result.append(spark.sql(text, **used))
    return result


@query(
    "run_state",
    """select concat('run-', cast(o_orderkey as varchar(20))) as id, case when o_orderstatus = 'O' then 'running' when o_orderstatus = 'F' then 'completed' else 'failed' end as status,
 case when o_orderstatus = 'P' then o_orderpriority end as error_message from orders""",
)
def run_state(spark, sf_dir):
    """Start and end events folded to the current state of each run."""
    orders = table(spark, sf_dir, "orders")
    run_id = F.concat(F.lit("run-"), F.col("o_orderkey").cast("string"))
    none_text, none_time = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    started = orders.select(
        run_id.alias("id"), F.lit("running").alias("status"), none_time.alias("finished_at"),
        none_text.alias("error_message"), F.col("o_orderdate").alias("event_at"),
    )
    ended = orders.filter(F.col("o_orderstatus") != "O").select(
        run_id.alias("id"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"),
        F.col("o_orderdate").alias("finished_at"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("error_message"),
        F.col("o_orderdate").alias("event_at"),
    )
    return current_runs(started.unionByName(ended)).select("id", "status", "error_message")


def _resolved(partition: str) -> str:
    return f"""with {_RUNS}, {_ARTIFACTS}, {_MODELS},
 done as (select m.id, m.name, m.version, a.object_key as model_key, a.pipeline_run_id, r.finished_at from models m join artifacts a on m.artifact_id = a.id
  join runs r on r.id = a.pipeline_run_id where r.status = 'completed'),
 picked as (select * from (select *, row_number() over (partition by {partition} order by finished_at desc nulls last, id) as rn from done) t where rn = 1),
 prepared as (select pipeline_run_id, min(object_key) as preprocessor_key from artifacts where kind = 'preprocessor' group by pipeline_run_id)
 select name, version, model_key, preprocessor_key, pipeline_run_id from picked left join prepared using (pipeline_run_id)"""


@query("registry_resolve", _resolved("name"))
def registry_resolve(spark, sf_dir):
    runs, artifacts, models = _derived(spark, sf_dir, _RUNS, _ARTIFACTS, _MODELS)
    return resolve_models(models, artifacts, runs)


@query("registry_resolve_versions", _resolved("name, version"))
def registry_resolve_versions(spark, sf_dir):
    runs, artifacts, models = _derived(spark, sf_dir, _RUNS, _ARTIFACTS, _MODELS)
    return resolve_models(models, artifacts, runs, per_version=True)


_KNOWN = """known as (select concat('key-', cast(user_id as varchar(20))) as object_key, sha256(min(props)) as sha256 from events group by user_id)"""
_INCOMING = """incoming as (select concat('key-', cast(user_id * 2 as varchar(20))) as object_key, sha256(min(props)) as sha256 from events where event_type = 'view' group by user_id, event_type
 union all select concat('key-', cast(user_id as varchar(20))), sha256(min(props)) from events group by user_id)"""


def _known_and_incoming(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    key = lambda c: F.concat(F.lit("key-"), c.cast("string")).alias("object_key")
    digest = F.sha2("props", 256).alias("sha256")
    lowest = events.groupBy("user_id").agg(F.min("props").alias("props"))
    viewed = events.filter(F.col("event_type") == "view").groupBy("user_id").agg(F.min("props").alias("props"))
    known = lowest.select(key(F.col("user_id")), digest)
    incoming = viewed.select(key(F.col("user_id") * 2), digest).unionByName(lowest.select(key(F.col("user_id")), digest))
    return known, incoming


@query(
    "registry_conflicts",
    f"""with {_KNOWN}, {_INCOMING}, pairs as (select * from known union all select * from incoming)
 select object_key from pairs where object_key in (select object_key from incoming) group by object_key having count(distinct sha256) > 1""",
)
def registry_conflicts(spark, sf_dir):
    return artifact_conflicts(*_known_and_incoming(spark, sf_dir))


@query(
    "registry_insert",
    f"with {_KNOWN}, {_INCOMING} select distinct object_key from incoming where object_key not in (select object_key from known)",
)
def registry_insert(spark, sf_dir):
    known, incoming = _known_and_incoming(spark, sf_dir)
    return new_artifacts(known, incoming).select("object_key")


_DATASETS = """old_sets as (select concat('art-', cast(o_custkey as varchar(20))) as artifact_id, 'sales' as name, count(*) as row_count from orders where o_totalprice > 450000 group by o_custkey),
 new_sets as (select concat('art-', cast(c_custkey as varchar(20))) as artifact_id, case when c_mktsegment = 'BUILDING' then 'other' else 'sales' end as name,
  (select count(*) from orders where o_custkey = c_custkey) as row_count from customer)"""


def _datasets(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    sizes = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("row_count"))
    artifact = lambda c: F.concat(F.lit("art-"), F.col(c).cast("string")).alias("artifact_id")
    large = orders.filter(F.col("o_totalprice") > 450000).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("row_count"))
    known = large.select(artifact("o_custkey"), F.lit("sales").alias("name"), "row_count")
    incoming = customer.join(sizes, customer.c_custkey == sizes.o_custkey, "left").select(
        artifact("c_custkey"),
        F.when(F.col("c_mktsegment") == "BUILDING", "other").otherwise("sales").alias("name"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )
    return known, incoming


@query(
    "dataset_conflicts",
    f"with {_DATASETS} select n.artifact_id from new_sets n join old_sets o using (artifact_id) where n.name <> o.name or n.row_count <> o.row_count",
)
def dataset_conflict_rows(spark, sf_dir):
    return dataset_conflicts(*_datasets(spark, sf_dir))


@query(
    "dataset_insert",
    f"with {_DATASETS} select artifact_id, name, row_count from new_sets where artifact_id not in (select artifact_id from old_sets)",
)
def dataset_insert(spark, sf_dir):
    return new_datasets(*_datasets(spark, sf_dir)).select("artifact_id", "name", "row_count")


@query(
    "stored_datasets",
    f"""with {_ARTIFACTS} select o_orderkey as id, a.object_key, o_orderpriority as name from orders join artifacts a
 on concat('art-', cast(o_orderkey as varchar)) = a.id where a.object_key like 'store/purchase/%'""",
)
def stored_dataset_rows(spark, sf_dir):
    """Orders as datasets, met with the key of their artifact and filtered on it."""
    (artifacts,) = _derived(spark, sf_dir, _ARTIFACTS)
    artifact = F.concat(F.lit("art-"), F.col("o_orderkey").cast("string")).alias("artifact_id")
    datasets = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), artifact, F.col("o_orderpriority").alias("name"))
    stored = stored_datasets(datasets, artifacts).filter(F.col("object_key").like("store/purchase/%"))
    return stored.select("id", "object_key", "name")


@query(
    "missing_keys",
    "select distinct concat('u/', cast(l_suppkey as varchar), '/', cast(l_partkey as varchar)) as object_key from lineitem where l_returnflag = 'R' except "
    "select concat('u/', cast(l_suppkey as varchar), '/', cast(l_partkey as varchar)) from lineitem where l_returnflag <> 'R'",
)
def missing_key_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    key = F.concat_ws("/", F.lit("u"), F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")).alias("object_key")
    wanted = lines.filter(F.col("l_returnflag") == "R").select(key)
    return missing_keys(wanted, lines.filter(F.col("l_returnflag") != "R").select(key))


@query(
    "registry_rules",
    f"""with {_RUNS}, {_ARTIFACTS}, {_MODELS}
 select 'pipeline_runs' as relation, 'unique id' as rule, (select count(*) from (select id from runs group by id having count(*) > 1) t) as violations
 union all select 'pipeline_runs', 'length status', (select count(*) from runs where length(status) > 32)
 union all select 'artifacts', 'unique id', (select count(*) from (select id from artifacts group by id having count(*) > 1) t)
 union all select 'artifacts', 'unique object_key', (select count(*) from (select object_key from artifacts group by object_key having count(*) > 1) t)
 union all select 'artifacts', 'reference pipeline_run_id', (select count(*) from artifacts where pipeline_run_id not in (select id from runs))
 union all select 'artifacts', 'length kind', (select count(*) from artifacts where length(kind) > 32)
 union all select 'artifacts', 'length object_key', (select count(*) from artifacts where length(object_key) > 512)
 union all select 'models', 'unique id', (select count(*) from (select id from models group by id having count(*) > 1) t)
 union all select 'models', 'unique artifact_id', (select count(*) from (select artifact_id from models group by artifact_id having count(*) > 1) t)
 union all select 'models', 'reference artifact_id', (select count(*) from models where artifact_id not in (select id from artifacts where kind = 'dataset' or object_key like 'store/view%'))
 union all select 'models', 'length name', (select count(*) from models where length(name) > 128)
 union all select 'models', 'length version', (select count(*) from models where length(version) > 128)""",
)
def registry_rules(spark, sf_dir):
    """Clicks and purchases lose their artifacts here, so one reference rule is broken on purpose."""
    runs, artifacts, models = _derived(spark, sf_dir, _RUNS, _ARTIFACTS, _MODELS)
    fewer = artifacts.filter((F.col("kind") == "dataset") | F.col("object_key").like("store/view%"))
    whole = rule_violations({"pipeline_runs": runs, "artifacts": artifacts})
    return whole.unionByName(
        rule_violations({"models": models, "artifacts": fewer}).filter(F.col("relation") == "models")
    )


@query(
    "lineage",
    """with recursive walk(id, root, depth) as (select cast(c_custkey as varchar), cast(c_custkey as varchar), cast(0 as bigint) from customer where c_custkey < 5
 union all select cast(c_custkey as varchar), w.root, w.depth + 1 from customer c join walk w on w.id = cast(c_custkey // 5 as varchar) where c_custkey >= 5)
 select id, root as root_id, depth from walk""",
)
def lineage_rows(spark, sf_dir):
    """Each customer key stands for a dataset made from the one with a fifth of its key."""
    customer = table(spark, sf_dir, "customer")
    datasets = customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_custkey") >= 5, F.floor(F.col("c_custkey") / 5).cast("string")).alias("source_dataset_id"),
    )
    return lineage(datasets)


@query(
    "run_values",
    """select 'run-1' as run_id, 'metric' as kind, key, cast(value as varchar) as value from (
 select 'n_lines' as key, count(*) as value from lineitem union all select 'n_parts', count(distinct l_partkey) from lineitem) t""",
)
def run_values(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_partkey").alias("n_parts"))
    return values_long("run-1", "metric", wide)
