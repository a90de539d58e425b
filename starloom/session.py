"""Session helpers: one place for the settings every starloom job relies on."""

from __future__ import annotations

import os
import tempfile
from datetime import datetime

from pyspark.sql import SparkSession

# Fixed values shared with the warehouse contract: the open-version sentinel of every versioned table and the
# fallback used when a validity start is missing.
FAR_FUTURE = datetime(9999, 12, 31, 23, 59, 59)
DEFAULT_VALID_FROM = datetime(1900, 1, 1, 0, 0, 0)


def ts_lit(v):
    """A ``TIMESTAMP_NTZ`` literal built from text, so its wall-clock value never depends on a time zone."""
    from pyspark.sql import functions as F

    if isinstance(v, datetime):
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(v).cast("timestamp_ntz")


def build_session(
    app: str = "starloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    * UTC session time zone, timestamps stay ``TIMESTAMP_NTZ`` end to end;
    * AQE on, with partition coalescing and skew-join splitting, so join strategy and reducer counts are
      picked from runtime sizes;
    * Spark UI off (batch jobs, nothing to serve).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.timestampType": "TIMESTAMP_NTZ",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read here. When it is unset and the master is
    local (tests), a folder is chosen -- ``fallback`` or a fresh temp dir -- and registered with the session.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = fallback or tempfile.mkdtemp(prefix="starloom-ckpt-")
    os.makedirs(d, exist_ok=True)
    spark.sparkContext.setCheckpointDir(d)
    return d
