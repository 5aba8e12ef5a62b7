"""Session helpers: building a local session for tests, and the shared scratch folder.

On a cluster the session is given; the scratch root is the folder named by
``spark.checkpoint.dir`` (a shared file system), never a machine-local temp folder.
A folder of our own is set only where the setting is missing, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on (time zone for NTZ <-> TIMESTAMP casts, AQE for
# skew and coalescing); tuned further per job by ``tune_for_scale``.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (``local[cores]``)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    """Apply the runtime setting the operators expect to an existing session (UTC, for
    casts between zoned and zone-less timestamps); writers pass their own options."""
    spark.conf.set("spark.sql.session.timeZone", BASE_CONF["spark.sql.session.timeZone"])
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a fresh one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")   # local tests: one machine, one folder
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A new, unique folder below the shared checkpoint root (for streaming inputs,
    checkpoints of stream queries and intermediate tables)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/tidewater-scratch/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_conf(spark: SparkSession, settings: dict):
    """Temporarily change session settings (a streaming query copies the session's when it starts)."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shuffle_partitions(spark: SparkSession, n: int | None):
    """Temporarily set ``spark.sql.shuffle.partitions`` (a streaming query fixes its state
    partitions from this value when it starts; the session keeps its own setting)."""
    return session_conf(spark, {} if n is None else {"spark.sql.shuffle.partitions": n})


def materialize(df, label: str = "stage"):
    """Write ``df`` once to a new folder below the shared checkpoint root and read it back.

    For small intermediates that several branches of a plan reuse (Spark reuses an
    exchange only when the branches prune it identically, so each branch would otherwise
    recompute it from the raw tables), and to cut lineage: a lost executor re-reads the
    files instead of recomputing from the source."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
