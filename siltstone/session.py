"""What driver and executors share: this package's code, and a folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    On one machine (tests) a temporary folder is set where none is named; on a cluster that is an error, since executors
    would not see the driver's folder.
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="siltstone-shared-"))
    return sc._jsc.sc().getCheckpointDir().get()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for one run's files. Results read from there lazily, so it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4()}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def ship_package(spark: SparkSession) -> None:
    """Executors get this package from the driver, once a context, so that Python functions need no installation of their own."""
    sc = spark.sparkContext
    if getattr(sc, "_siltstone_shipped", False):
        return
    top = Path(__file__).resolve().parent
    path = f"{tempfile.mkdtemp(prefix='siltstone-package-')}/siltstone.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(path)
    sc._siltstone_shipped = True
