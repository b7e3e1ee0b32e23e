"""Session settings, shared scratch space and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = 8, app: str = "wideloom", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return ship_package(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session, where
    every task sees the same disk, falls back to a temporary folder.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if not (sc.master == "local" or sc.master.startswith("local[")):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="wideloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: iterative plans stay short and outlive lost executors."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(scratch_dir(spark), f"wideloom-{name}-{uuid.uuid4().hex}")


def cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors (once per application)."""
    sc = spark.sparkContext
    if getattr(sc, "_wideloom_shipped", None) != sc.applicationId:
        root = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="wideloom-"), "wideloom.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        path = os.path.join(folder, f)
                        z.write(path, os.path.relpath(path, os.path.dirname(root)))
        sc.addPyFile(archive)
        sc._wideloom_shipped = sc.applicationId
    return spark
