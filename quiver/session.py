"""SparkSession settings shared by tests, bench and the driver entry point."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings every quiver job relies on: UTC for tz-free timestamps, ANSI casts,
# AQE for runtime join selection, partition coalescing and skew splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove RDD checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quiver", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with quiver's settings.

    Without ``master`` the one that spark-submit or the Spark configuration
    names is used; only where none is named, ``local[$BENCH_CPUS or *]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and SparkSession.getActiveSession() is None and not SparkConf().get("spark.master", None):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.ui.") or k.startswith("spark.cleaner."):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an already-running session
            pass
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, so that they can import it wherever the
    driver was started. Spark copies the archive to the executors; done once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_quiver_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quiver-ship-"), "quiver.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith((".py", ".txt")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("quiver", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._quiver_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read here. Only
    when it is unset in local mode (tests on a laptop) a folder of our own is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = os.path.join("/tmp", "quiver-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


@contextmanager
def dropping_shuffles(spark: SparkSession, every: float = 4.0):
    """Spark deletes a shuffle's files once the driver's JVM has collected the objects that
    refer to it, and by itself asks for that every half an hour
    (``spark.cleaner.periodicGC.interval``). Inside this block it is asked every ``every``
    seconds and at the end. Shuffles that a plan still refers to stay."""
    jvm, ended = spark.sparkContext._jvm, threading.Event()

    def ask() -> None:
        while not ended.wait(every):
            jvm.System.gc()

    asking = threading.Thread(target=ask, daemon=True)
    asking.start()
    try:
        yield
    finally:
        ended.set()
        asking.join()
        gc.collect()  # Python's handles on JVM objects
        jvm.System.gc()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediates."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/quiver-{name}-{uuid.uuid4().hex[:12]}"
