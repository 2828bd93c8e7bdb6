"""Session and scratch-space helpers.

Nothing here creates a cluster-specific setting: on a cluster the session is
built by the platform, ``spark.checkpoint.dir`` names a shared folder and we
only read it.  ``get_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "salesboard") -> SparkSession:
    """Local session with the settings our queries assume.

    * session time zone UTC: record times are zone-free text, and the oracle
      engine works in UTC;
    * AQE on (coalesces small shuffles, splits skewed partitions, turns a
      sort-merge join into a broadcast one when a side turns out small);
    * no web UI.
    """
    master = master or os.environ.get("SALESBOARD_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("SALESBOARD_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SALESBOARD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Record times are wall-clock text; interpret them in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables, stream checkpoints and lineage cuts.

    Read from the session (``spark.checkpoint.dir``, which the cluster points
    at shared storage).  Only when it is unset -- local runs and tests -- a
    temporary folder is chosen and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="salesboard-"))
    return sc.getCheckpointDir().rstrip("/")


@contextlib.contextmanager
def conf_override(spark: SparkSession, settings: dict):
    """Set runtime SQL confs for a block, then restore the previous values."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """``DataFrame.checkpoint()`` needs a checkpoint dir; make sure one is set."""
    scratch_root(spark)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique sub-folder of the scratch root (never reused, never cleared)."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
