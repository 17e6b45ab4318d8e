"""Session used by the tests and the benchmark; jobs accept any session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def _shared_folder() -> str:
    """On one machine any folder is shared; a session that is there already keeps its own."""
    active = SparkSession.getActiveSession()
    known = active.conf.get("spark.checkpoint.dir", None) if active else None
    return known or tempfile.mkdtemp(prefix="skyledger-")


def local_session(app: str = "skyledger", cores: str | int = "*") -> SparkSession:
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", _shared_folder())
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
