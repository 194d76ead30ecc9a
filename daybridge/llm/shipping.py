"""Makes this package importable in Python workers, wherever the driver imported it from."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import daybridge

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the workers, once per application (as ``--py-files`` would)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(daybridge.__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="daybridge-package-")) / "daybridge_sources.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query or stage, with the package sent to the workers first."""

    @wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        ship_package(spark)
        return query(spark, *rest)

    return run
