"""Session construction and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  Times are stored as
# TIMESTAMP_NTZ holding UTC wall clock, so the session zone must be UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a generated method of more bytecode than this is never compiled by the JVM; wide projections (55 columns) run
    # faster outside whole-stage code than in a method that stays interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # queries write reliable checkpoints (per-query dimensions, rank inputs);
    # remove their files once the driver no longer references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app: str = "marketlake", extra: dict | None = None) -> SparkSession:
    """A session with the settings the operators rely on.  The number of
    shuffle partitions is the cluster's own unless given (tests, the bench)."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Register the shared checkpoint folder with the SparkContext.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master
    may go without: there (tests, the bench) a scratch folder is made.  On
    any other master an unset folder is an error, because files in a
    machine-local folder are not there for other executors.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="marketlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    sc.setCheckpointDir(base)


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder (never a
    local checkpoint): later branches read the written files instead of
    recomputing the plan, and survive executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """The path of a fresh sub-folder of the cluster's shared folder.

    It lies in the folder Spark made for this application (its name holds a
    random id) and ends in a random id itself, so that neither two jobs with
    the same process number nor two calls of one job can meet.  The path
    keeps its scheme.
    """
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir().rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
