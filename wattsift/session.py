"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "wattsift") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the submitter configures it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the one the cluster names in spark.checkpoint.dir.

    A machine-local folder is used only where the setting is absent and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
        app = spark.sparkContext.applicationId
        if app not in _fallback:
            _fallback[app] = tempfile.mkdtemp(prefix="wattsift-")
        root = _fallback[app]
    return os.path.join(root, f"wattsift-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write once to the shared folder and go on from the written table.

    Used where a plan is read several times and is dear or unstable to recompute (Python scoring,
    sampled range bounds).  Unlike a cached block, a written table outlives a lost executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(written: DataFrame) -> None:
    """Remove a table of ``materialise`` that nothing reads any more, so that rounds do not pile up on the disk."""
    spark = written.sparkSession
    for folder in {os.path.dirname(f) for f in written.inputFiles()}:
        if os.path.dirname(folder).rstrip("/").endswith(os.path.basename(scratch_dir(spark))):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(scan: DataFrame) -> DataFrame:
    """One task per core at least, for a plain scan that feeds CPU-heavy steps.

    A table of many files is left alone; a few unsplittable files would otherwise keep a few cores busy.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
