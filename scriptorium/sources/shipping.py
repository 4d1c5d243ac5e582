"""Getting the package to the Python workers of a session."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> SparkSession:
    """Let the workers of a session import this package: by path where they share this machine's files, else from an archive sent to each executor."""
    sc = spark.sparkContext
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if str(ROOT) not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([str(ROOT), *filter(None, paths)])
        if sc.master != "local" and not sc.master.startswith("local["):
            sc.addPyFile(shutil.make_archive(f"{_folder(spark)}/scriptorium", "zip", ROOT, "scriptorium"))
    return spark


def _folder(spark: SparkSession) -> str:
    """A new folder for the archive: in the shared folder that the session names if that is a mounted path, else one of the driver, from which Spark serves the archive."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or ""
    place = shared.removeprefix("file://").removeprefix("file:")
    if place.startswith("/"):
        os.makedirs(place, exist_ok=True)
        return tempfile.mkdtemp(prefix="scriptorium-", dir=place)
    return tempfile.mkdtemp(prefix="scriptorium-")
