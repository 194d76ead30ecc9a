"""Evidence that a frame is sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def order_faults(df: DataFrame, columns: Sequence[str], *, nulls_first: bool = True) -> DataFrame:
    """One row: n_rows, inversions and partitions of a frame, in the order in which it would be written or collected.

    An inversion is a row that comes before its predecessor by ``columns`` (ascending), inside a partition or over the edge
    of two. Inside, a partition's rows are compared in their place, one partition per task; over the edges, the first and last row of
    every partition are: a row per partition. An empty frame has no row and no inversion.
    """
    key = []
    for i, c in enumerate(columns):
        column, null = F.col(_quote(c)), F.col(_quote(c)).isNull()
        key += [(~null if nulls_first else null).alias(f"n{i}"), column.alias(f"c{i}")]
    placed = df.select(
        F.struct(*key).alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    )
    inside = Window.partitionBy("part").orderBy("place")
    stepped = placed.withColumn("back", F.col("key") < F.lag("key").over(inside))
    parts = stepped.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("back").alias("back"),
        F.min_by("key", "place").alias("first"),
        F.max_by("key", "place").alias("last"),
    )
    # a row per partition from here on
    edge = parts.withColumn("edge", F.col("first") < F.lag("last").over(Window.orderBy("part")))
    return edge.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        (F.coalesce(F.sum("back"), F.lit(0)) + F.count_if("edge")).alias("inversions"),
        F.count(F.lit(1)).alias("partitions"),
    )
