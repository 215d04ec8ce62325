"""Session settings the plans rely on, and the shared folder used to cut lineage."""

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "moodmart", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; ``settings`` use ``__`` for dots (``spark__sql__shuffle__partitions``)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder checkpoints go to.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local session may fall back to a folder of its
    own; elsewhere a machine-local folder would be lost with the machine, so the setting is required.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
        return configured
    # local-cluster has executors of its own
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="moodmart-checkpoint-")
    context.setCheckpointDir(own)
    return own


def settle(frame: DataFrame) -> DataFrame:
    """Compute a frame once and keep it in the checkpoint folder.

    For small results that several later plans need (a dimension, a list of keys): they read the stored rows, are not
    recomputed from the raw tables, and survive the loss of any executor.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def stage(frame: DataFrame) -> DataFrame:
    """Write a frame as a Parquet table of its own below the checkpoint folder, and read it back.

    For a large result with several readers, each of which wants few of its columns. The folder's retention rules
    remove it, like any checkpoint.
    """
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/staged-{uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
