"""Session factory: UTC, adaptive execution, ANSI arithmetic, no UI."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "lakestar", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every operator here assumes; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | (conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session whose executors are the driver's own process may do without: it gets a local folder, which goes when
    the process ends. Elsewhere a missing setting raises, for other machines couldn't see such a folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="lakestar-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        found = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")
