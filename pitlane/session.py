"""Session helper: one place for the settings every operator relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators' results depend on (not tuning):
#  - UTC session zone: business-date and day-of-week logic is written against it.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
}

# Tuning for a local run, used by the tests and bench.py only: a cluster submit
# brings its own, and get_session must not override it.
LOCAL_TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "pitlane", extra: dict | None = None) -> SparkSession:
    """Return the active session, or create one.

    Sets only what results depend on (`_REQUIRED`) and what the caller passes
    in `extra`; settings of a spark-submit or of a running session stay."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_REQUIRED, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that they share local folders."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder that `spark.checkpoint.dir` names, which driver and executors share.

    Only where it is unset and the master is local (tests) a scratch folder is
    made; on a cluster an unset folder is an error, as no local folder is shared."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pitlane-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df):
    """Cut a long lineage before an iterative consumer (model fitting, k-fold
    loops): a reliable checkpoint into the shared `spark.checkpoint.dir`, so a
    lost executor re-reads the files instead of recomputing the lineage.
    (Never localCheckpoint: its blocks die with the executor.)"""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
