"""Spark session helpers.

Library code never creates its own session: every operator takes a
DataFrame and returns one.  These helpers are for tests, the benchmark and
small command-line uses.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "panelcast", extra: dict | None = None) -> SparkSession:
    """A local session with the settings the library assumes.

    UTC session time zone (dates and ``TIMESTAMP_NTZ`` values are used
    without zone), AQE on (runtime coalescing, skew-join splitting and
    runtime broadcast conversion), Arrow on for the pandas functions.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # files go with the last reference
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder, from ``spark.checkpoint.dir``.

    On a cluster the setting names a folder that all executors share.  Where
    it is unset, a local session (one machine, as in tests) gets a scratch
    folder; any other session is told to set it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[[^-]*\])?$", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="panelcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Materialise ``df`` into the reliable checkpoint folder.

    Used between heavy stages so that a lost executor replays from the
    checkpoint instead of from the raw scan.  Never a local checkpoint:
    those live on executor disks and vanish with the executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make ``panelcast`` importable in Python workers (``addPyFile`` of a zip, once per context).

    The pandas functions (``mapInPandas``/``applyInPandas``) refer to this
    package's modules, which workers import by name.  On a cluster the
    package can equally be shipped with ``--py-files``; this helper does
    the same from inside the job.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_panelcast_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="panelcast-py-")
    path = os.path.join(out_dir, "panelcast.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._panelcast_shipped = True
