"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quipuflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUIPUFLOW_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Lets Python workers that see this folder import the package; elsewhere it comes with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where none is named, a temporary one on a local master, and an error on a cluster."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quipuflow-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """df behind a reliable checkpoint, so that a lost executor costs no recomputation from the start."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores.

    Only an input of fewer partitions, which is small, is shuffled; for steps that cost far more than
    reading their rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
