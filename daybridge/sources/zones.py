"""Key -> IANA time-zone dimension read from a CSV file with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_zones(
    spark: SparkSession,
    path: str,
    *,
    key_col: str = "iata_code",
    zone_col: str = "iana_tz",
) -> DataFrame:
    """Scan the zone CSV on the executors and keep the two columns used.

    Columns are read as text (no inference pass); other columns in the file
    are ignored.
    """
    raw = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    missing = [c for c in (key_col, zone_col) if c not in raw.columns]
    if missing:
        raise ValueError(f"zone file {path} lacks columns {missing}; it has {raw.columns}")
    return raw.select(F.col(key_col), F.col(zone_col))
