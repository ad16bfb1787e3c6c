"""Session helpers: a tuned local session and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "salesflow",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return a session with AQE on, UTC time and no UI.

    On a cluster the master and sizes come from the submit configuration;
    these settings only fill in what the launcher left unset.
    """
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    builder = (SparkSession.builder
               .appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
               .config("spark.sql.shuffle.partitions",
                       str(shuffle_partitions or max(8, 2 * cpus))))
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    When a local session has none (unit tests, a laptop), a folder is
    created under the local temp dir and registered as the checkpoint dir.
    Off a local master that raises: executors on other machines would not
    see such a folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this client (e.g. Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.conf.get("spark.master", None) or (sc.master if sc is not None else "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="salesflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/salesflow-{name}-{uuid.uuid4().hex[:12]}"


def unique_table(prefix: str) -> str:
    """A catalog table name that no other run uses."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
