"""Session helpers: a local builder for tests and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "formloom", **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    A folder of our own is made only in local mode; on a cluster a missing
    setting is an error, since a machine-local folder would be lost with its
    executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for loops that refine a DataFrame round by round."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """A table written to the checkpoint folder as Parquet and read back, where
    several steps read it: its columns take a fraction of a checkpoint's rows."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
