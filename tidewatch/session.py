"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_FALLBACK: dict[str, str] = {}


def build_session(app_name: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Shuffle partition count is left to adaptive execution: the initial number is a ceiling that AQE
    coalesces, so one value serves small and large inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only a session in one process (``local[..]``) may go without; it gets a temporary folder, once per
    application.  On a cluster a missing setting is an error: executors would write to their own disks.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _FALLBACK:
        _FALLBACK[application] = tempfile.mkdtemp(prefix="tidewatch-")
    return _FALLBACK[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: survives executor loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
