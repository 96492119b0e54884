"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The settings the results depend on (time zone, ANSI errors) or the plans rely on (AQE).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "siltstone", **extra: str) -> SparkSession:
    """A session with the settings above. On a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named in ``spark.checkpoint.dir``.

    Only a local session may leave it out (tests, laptops): a fresh temporary folder is made and
    remembered in the session. On a cluster, where executors would each write to a disk of their own,
    that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Write a step that is read several times to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
