"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: str = "8", app: str = "tablesift", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # files of checkpoints that nothing refers to any more are deleted
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, because a machine-local folder would
    be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tablesift-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts the lineage and survives executor loss."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def observed_checkpoint(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """A reliable checkpoint and aggregates over its rows, in one job."""
    observation = Observation()
    kept = checkpoint(df.observe(observation, *[c.alias(k) for k, c in metrics.items()]))
    return kept, observation.get
