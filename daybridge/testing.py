"""Local session for tests, scripts and the benchmark (not used by the operators)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A ``local[cores]`` session: UTC, adaptive execution on, no web UI.

    The warehouse goes to a fresh temporary folder. The checkpoint folder is
    left to the environment when it names one; otherwise the scratch helper
    creates one on first use.
    """
    warehouse = tempfile.mkdtemp(prefix="daybridge-warehouse-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daybridge-local")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("DAYBRIDGE_SESSION_TZ", "UTC"))
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.driver.memory", os.environ.get("DAYBRIDGE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
