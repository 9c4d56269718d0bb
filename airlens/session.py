"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "airlens", driver_memory: str | None = "8g") -> SparkSession:
    """A session for scripts and tests: UTC clock, AQE on, UI off. In local
    mode the driver heap is the only heap, so size it (applies only when
    this call starts the JVM)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = (
        builder.config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Hours and 5-minute windows are defined on the UTC clock (a half-hour
    zone would misalign them), so pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own
    (tests); a cluster session must name a shared folder, since a
    machine-local one does not survive a lost executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...)")
        root = tempfile.mkdtemp(prefix="airlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared checkpoint folder; Spark's writers create it."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/airlens/{label}-{uuid.uuid4().hex[:12]}"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers with Spark's own file server, once a
    context (a cluster need not have it installed)."""
    sc = spark.sparkContext
    if getattr(sc, "_airlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="airlens-zip-"), "airlens.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._airlens_shipped = True
