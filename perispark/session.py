"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "perispark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with UTC time, AQE and skew-join splitting; ``master`` is left to spark-submit on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the shared folder named in ``spark.checkpoint.dir``, or keep one that was set before.

    Only a local-mode session without either gets a temporary folder of its own, removed when the process ends; on a
    cluster a machine-local folder would be lost with its machine, so the missing setting is an error.
    """
    context = spark.sparkContext
    present = context._jsc.sc().getCheckpointDir()
    if present.isDefined():
        return present.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can read")
        folder = tempfile.mkdtemp(prefix="perispark-checkpoints-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def find_package(spark: SparkSession) -> None:
    """Let Python workers of a local master import this package from where the driver did; on a cluster it is installed."""
    context = spark.sparkContext
    if context.master.startswith("local"):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
