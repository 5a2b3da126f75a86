"""Session helpers: a tuned SparkSession and a shared scratch location.

Scratch data (stream landing zones, checkpoints, written intermediate tables)
always lives under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent (unit tests on a laptop) is a private folder
created and registered.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every streamlens job relies on.  Times in messages carry no zone, so
# the session zone is pinned to UTC; AQE re-plans shuffles at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def get_session(master: str | None = None, app: str = "streamlens",
                shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Base folder for scratch tables: ``spark.checkpoint.dir`` of the session.

    Falls back to the SparkContext checkpoint dir.  When neither is set, a
    single-process (``local``) session gets a fresh private folder that is then
    registered as the checkpoint dir; on a cluster that folder would be another
    one on every machine, so the missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="streamlens-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the shared dir (never reused)."""
    return f"{shared_dir(spark)}/streamlens/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared dir and read back: what it computes
    (or writes elsewhere) happens exactly once, whatever reads the result."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_utc(spark: SparkSession) -> None:
    """Message times carry no zone; streamlens reads them as UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
