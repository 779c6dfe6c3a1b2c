"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from draftledger import files

# Settings every job relies on: UTC dates, ANSI arithmetic (Spark 4 default), AQE for
# runtime re-planning (broadcast only when a side measures under the threshold, skew
# splitting, partition coalescing).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "draftledger", extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the settings above.

    On a cluster pass ``master=None`` and let spark-submit decide; ``shuffle_partitions``
    should then be sized so one shuffle partition stays around 128-256 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("DRAFTLEDGER_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and materialised tables.

    Read from the session (``spark.checkpoint.dir`` / the context's checkpoint dir). Only
    when nothing is configured on a local master (tests, a laptop) a scratch folder of our own
    is set; on a cluster that is an error, as executors would not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    else:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="draftledger-"))
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder (``spark.checkpoint.dir`` as configured, without the
    per-application subfolder Spark adds for checkpoints), for tables reused across runs."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return shared_dir(spark).rstrip("/")


def path_complete(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished Spark write (its ``_SUCCESS`` marker exists)."""
    return any(e.name == "_SUCCESS" for e in files.entries(spark, path))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used for tables that several later steps read (the scored titles, the pair table, the
    range-sorted rows of a ranking): the plan runs once instead of once per reader, the
    lineage is cut, and a lost executor costs a re-read instead of a recomputation. (An
    eager reliable ``checkpoint()`` would run the plan twice: once to count, once to save.)
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
