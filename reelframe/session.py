"""Session set-up for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(app: str = "reelframe", cores: int | str = 8, shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("REELFRAME_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local path would be lost with its executor.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY)
    root = named or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="reelframe-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per Spark context.

    Functions that run in tasks import it there; without this it has to be installed
    on every machine or lie on its ``PYTHONPATH``.
    """
    context = spark.sparkContext
    if not getattr(context, "_reelframe_shipped", False):
        folder = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='reelframe-')}/{folder.name}", "zip", folder.parent,
                                      folder.name)
        context.addPyFile(archive)
        context._reelframe_shipped = True
