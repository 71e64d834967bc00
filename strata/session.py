"""Session construction and shared scratch locations.

Scratch space for staged tables and checkpoints always lives under the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that
is unset (local runs, tests) do we pick a fresh local folder and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults tuned for correctness first (UTC, ANSI on) and for scale:
# AQE re-plans joins and coalesces/splits shuffle partitions at runtime, skew
# join splitting is on, and speculation stays off so side-effecting fetch
# tasks are not launched twice on purpose.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.speculation": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
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
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``strata`` importable in executor Python workers.

    Functions handed to ``mapInPandas``/``applyInPandas`` and data source
    readers are pickled by module reference, so workers must import this
    package. It is zipped once per SparkContext and distributed by Spark
    (``addPyFile``), which also reaches executors on other machines.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import os
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="strata-pyfiles-"), "strata.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names; a local one only where all runs in one process.

    On a cluster executors do not share this machine's folders, so there an
    unset ``spark.checkpoint.dir`` is an error.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder under the shared checkpoint root, unique per call."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/strata-{name}-{uuid.uuid4().hex[:12]}"


def fresh_schema(prefix: str = "strata") -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
