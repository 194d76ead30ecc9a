"""Run the daily load for every new file in a drop folder.

Structured Streaming only discovers the files and tracks which ones were
processed (in the checkpoint location); each micro-batch is handed to the same
``load_day`` as the batch job. With ``available_now=True`` the query processes
what is there and stops, which suits a scheduled run.

The files of a day may come in several micro-batches. The typed rows of each
micro-batch are therefore staged below the checkpoint location, in a folder per
day and under it one per micro-batch; the days it touches are then loaded from
all rows staged for them, and no other day's folder is read. A micro-batch that
is replayed after a failure replaces its own staged rows, so that every row is
in the table once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daybridge.operators.flatten import flatten
from daybridge.operators.project import name_key, project_typed
from daybridge.plans.daily import load_day
from daybridge.plans.flight_load import IngestConfig, with_utc
from daybridge.sources.json_source import prune_schema

_BATCH, _DAY = "_db_batch", "_db_day"


def watch_folder(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    config: IngestConfig,
    zones: DataFrame,
    *,
    checkpoint_location: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that loads each new JSON file of ``folder`` into the table.

    A file stream needs an explicit ``schema``. ``checkpoint_location`` must stay
    the same from run to run: it holds which files are done and the staged rows.
    Files of one micro-batch may hold several days; ``load_day`` handles them
    together. Later days that the table has are read as successor candidates, so
    that a late file of an old day keeps its tails.
    """
    if not checkpoint_location:
        raise ValueError("checkpoint_location is required: without it a restart loads every file again")
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    narrow = prune_schema(schema, [c.name for c in config.specs], fold=name_key(spark))
    raw = spark.readStream.schema(narrow).json(folder)
    staged = f"{checkpoint_location.rstrip('/')}/daybridge-rows"
    pcol = config.bridge.partition_col

    def _load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        typed = project_typed(flatten(batch, outer=config.read.outer, on_map=config.read.on_map), config.specs,
                              on_error=config.read.on_error)
        rows = with_utc(typed, config, zones)
        seen, day = Observation(f"days-{number}"), F.col(f"`{pcol}`")
        noted = rows.observe(seen, F.collect_set(day).alias("days"), F.count_if(day.isNull()).alias("undated"))
        noted = noted.withColumns({_DAY: day, _BATCH: F.lit(number)})
        # Only the folders (day, this micro-batch) are replaced; the days are noted by the writing tasks.
        writer = noted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(_DAY, _BATCH).parquet(staged)
        if seen.get["undated"]:
            raise ValueError(f"batch has rows with a null {pcol!r}")
        folders = [f"{staged}/{_DAY}={d}" for d in sorted(seen.get["days"])]
        if not folders:
            return
        touched = session.read.schema(rows.schema).parquet(*folders).select(*rows.columns)
        load_day(
            touched,
            config.output_table,
            config.bridge,
            location=config.table_location,
            lookahead_days=config.bridge.lookback_days,
            output_partitions=config.output_partitions,
        )
        # The batch runs in a cloned session; drop the caller's cached file list.
        spark.catalog.refreshTable(config.output_table)

    writer = raw.writeStream.foreachBatch(_load).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
