"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors can all reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    # the setting can't be changed in a running session, so the context remembers the folder
    if not hasattr(context, "_tidewheel_shared"):
        context._tidewheel_shared = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(context._tidewheel_shared)
    return context._tidewheel_shared


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_dir`; nothing is created or removed."""
    return f"{shared_dir(spark)}/tidewheel/{name}-{uuid.uuid4().hex}"


def parallelism(spark: SparkSession) -> int:
    """Number of pieces to cut ordered data into: follows the cluster's shuffle width."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session, for clusters on which it is not installed.

    Functions given to Spark name their module, and workers import it; they know nothing of the driver's path.
    """
    context = spark.sparkContext
    if getattr(context, "_tidewheel_shipped", False):
        return
    package = Path(__file__).resolve().parent
    # on the driver only, which serves it to the executors
    target = Path(tempfile.mkdtemp(prefix="tidewheel-")) / "tidewheel.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    context._tidewheel_shipped = True
