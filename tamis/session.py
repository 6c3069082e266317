"""Session set-up and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tamis", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is tuned for; ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.ui.showConsoleProgress": "false",
        # checkpoints go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder shared by all executors: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and all executors are this process (a local master, as in tests) a temporary folder
    is made; on a cluster it would be another one on each machine, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not named:
        named = tempfile.mkdtemp(prefix="tamis-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Survives the loss of any executor, unlike a local checkpoint or a cache.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for a table in the shared folder."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work one partition a core at least.

    A table of few files and row groups would otherwise keep most cores idle; tables with
    enough partitions pass through without a shuffle.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
