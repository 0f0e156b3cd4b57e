"""Session settings that the library is meant to run with."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(name: str = "civicframe", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Before Python runs on executors: gives them this package, once a session. On a cluster Spark's file server sends
    an archive of it; local workers find it where the driver has it.
    """
    context, home = spark.sparkContext, Path(__file__).resolve().parent
    context.environment.setdefault("PYTHONPATH", str(home.parent))
    if context.master.startswith("local") or context.environment.get("CIVICFRAME_SHIPPED"):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/civicframe", "zip", home.parent, home.name)
    context.addPyFile(archive)
    context.environment["CIVICFRAME_SHIPPED"] = "yes"
