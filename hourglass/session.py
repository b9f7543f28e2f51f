"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "hourglass") -> SparkSession:
    """Return a session tuned for this workload.

    On a cluster the master and memory come from spark-submit; the settings
    here are the ones the queries rely on: UTC session time (hour keys are
    wall-clock NTZ), AQE for runtime coalescing / skew splitting / broadcast
    conversion, and ANSI mode left on (every parse and division is guarded).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true"))
    if master and master.startswith("local"):
        # single-machine runs (tests, bench): no web UI, no console progress bars
        b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder (HDFS/S3/ABFS) there. Only a local master
    (tests, bench), where driver and executors are one process, may go
    without: it gets a temporary folder. Any other master without the setting
    is refused, because other nodes could not read what is written.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = local_checkpoint_dir(spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def local_checkpoint_dir(master: str) -> str:
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all nodes share (master {master})")
    return tempfile.mkdtemp(prefix="hourglass-ckpt-")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable on the executors of a cluster, whose Python
    functions import it: the driver's copy is sent to them once for each application
    (as ``spark-submit --py-files`` does). A local master has it already."""
    import os
    import zipfile
    sc = spark.sparkContext
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster") or getattr(sc, "_hourglass_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="hourglass-py-"), "hourglass.zip")  # on the driver; Spark sends it
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._hourglass_shipped = True
