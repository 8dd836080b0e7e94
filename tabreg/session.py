"""Session helpers: a tuned SparkSession and the shared checkpoint folder.

Lineage is cut with reliable ``checkpoint()`` (never ``localCheckpoint``),
into the folder the cluster names in ``spark.checkpoint.dir``. Only when
that setting is absent (local tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "tabreg",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage; we read it
    from the session. When it is absent (local tests) a fresh folder under
    the system temp dir is used for this session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tabreg-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, truncates the plan."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the checkpoint folder and read it back: lineage ends
    there, and the planner knows the table's size."""
    path = shared_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def persist_for_passes(df: DataFrame) -> DataFrame:
    """Persist an input that an iterative fit will read many times.

    One ``count()`` fills the cache (the pass the fit would make first
    anyway). Only then is the partition count read - from the cache, so no
    upstream stage runs twice. Inputs that arrive in fewer partitions than
    cores (small data: one partition per parquet row group) are spread
    over all cores; large inputs are returned as cached, with no shuffle.
    The caller unpersists the returned frame.
    """
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    cached.count()
    target = df.sparkSession.sparkContext.defaultParallelism
    if cached.rdd.getNumPartitions() >= target:
        return cached
    spread = cached.repartition(target).persist(StorageLevel.MEMORY_AND_DISK)
    spread.count()
    cached.unpersist()
    return spread
