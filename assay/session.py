"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from assay.sources.folders import remove

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Join by hash instead of sorting both sides when every partition of one side is measured
    # to be this small; sort-merge otherwise. Must not be below the advisory partition size. The
    # bytes are compressed and the hash table cannot spill, so a task must have several times as
    # much; the keys joined here are short and unpack to about three times their size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    # Splits a reduce partition that one hot key made large, on the many-rows side of a join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def build_session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the jobs are tuned for; ``settings`` use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Unset is only accepted in local mode, where one machine is the whole cluster.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    application = context.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="assay-")
    return _local_roots[application]


def new_run_root(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for one run's tables; nothing is ever written twice to the same place."""
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/assay/{application}/{purpose}-{uuid.uuid4().hex}"


def release_run(spark: SparkSession, root: str) -> None:
    """Remove a run's folder. Only its owner knows when nothing reads from it any more."""
    if not root.startswith(f"{shared_root(spark)}/assay/"):
        raise ValueError(f"{root} is no run folder")
    remove(spark, root)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back: short lineage, real file sizes, no recomputation."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
