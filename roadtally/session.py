"""Session settings and the shared folder for checkpoints and written intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "roadtally", master: str | None = None, **conf: str) -> SparkSession:
    """Session for stand-alone runs: UTC, adaptive execution with skew handling.

    Code that receives a session never changes its settings; this builder is the only place that sets any.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without: there a temporary folder is set once and reused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)  # set on the session after its context was made
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="roadtally-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows computed once and cut off from their lineage, in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def release_shuffles(spark: SparkSession) -> None:
    """Ask for a collection, so that Spark's cleaner deletes the files of shuffles that nothing can read again."""
    gc.collect()
    spark._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
