"""Spark session helpers.

The library never hard-codes a cluster layout. ``get_spark`` is for tests,
scripts and the bench; on a cluster callers hand in their own session and
only ``ensure_checkpoint_dir`` touches it (and only when nothing is set).
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode: a whole-stage-codegen method
    # above that runs interpreted (4x slower on the 20-disease scoring projection). Above this
    # limit Spark falls back to per-expression code, which is split into JIT-able methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # rank inputs and training frames are checkpointed; remove the files once they are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "riskloom", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; create a scratch one only on a plain local master.

    On a cluster the conf names a shared folder every executor can reach; without it
    this raises, since a folder of one machine would be unreadable elsewhere.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif is_one_machine(sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def is_one_machine(master: str) -> bool:
    """``local`` and ``local[...]``: driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def ship_code(spark: SparkSession) -> None:
    """Give the tasks' Python this package, once per context, however the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_riskloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="riskloom-code-"), "riskloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    sc.addPyFile(archive)
    sc._riskloom_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
