"""Session builder and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "featurelake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator expects (UTC, AQE).

    On a cluster leave ``master`` unset and let spark-submit decide. Shuffle partitions are a
    ceiling that AQE coalesces, so a cluster run should pass a value sized to its data.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.ui.enabled", "false").config(
                "spark.sql.shuffle.partitions", "8"
            )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, named by ``spark.checkpoint.dir``.

    Only where the session names none (local tests) is a fresh temporary folder made.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="featurelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut_lineage(df):
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)
