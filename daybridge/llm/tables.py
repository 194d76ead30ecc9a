"""Tables between the steps of an operator, below the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybridge.sources.scratch import free, scratch_path


class Tables:
    """Writes steps as Parquet and reads them back, so that no lost executor takes a run further back; drops them when done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, label: str, df: DataFrame) -> DataFrame:
        self.paths[label] = scratch_path(self.spark, label)
        df.write.parquet(self.paths[label])
        return self.spark.read.schema(df.schema).parquet(self.paths[label])

    def drop(self, *labels: str) -> None:
        """Delete tables that no later step reads."""
        for label in labels:
            free(self.spark, self.paths.pop(label))
