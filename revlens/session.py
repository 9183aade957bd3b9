"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins at run
# time (broadcast when a side turns out small, split skewed partitions);
# the UI stays off because no server may be opened.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app_name: str = "revlens",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("REVLENS_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset.

    On a cluster the setting names a shared folder every executor can reach;
    a machine-local fallback is only created for local runs such as tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="revlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return scratch


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship_package(spark: SparkSession) -> None:
    """Make ``revlens`` importable in every Python worker (``addPyFile``).

    Pandas functions run in executor processes that do not share the
    driver's ``sys.path``; the package is zipped once per session and shipped
    by Spark itself to every executor (local or cluster).
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_revlens_shipped", False):
        return
    import revlens
    pkg = os.path.dirname(os.path.abspath(revlens.__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="revlens-pkg-"), "revlens.zip")
    with zipfile.ZipFile(out, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._revlens_shipped = True
