"""Batch entry point: load a whole history of JSON files in one job.

    spark-submit --py-files daybridge.zip daybridge/jobs/bulk_load.py CONFIG.json DATA_DIR_OR_FILES... --zones ZONES.csv

Gives the table that loading the days one by one in ascending order gives
(see ``bulk_bridge``), with one shuffle for the whole history.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from daybridge.plans.daily import bulk_load
from daybridge.plans.flight_load import IngestConfig, prepare_batch
from daybridge.sources.scratch import free, scratch_path
from daybridge.sources.zones import read_zones

log = logging.getLogger("daybridge.bulk_load")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load many JSON batches into a date-partitioned table at once.")
    parser.add_argument("config", help="JSON config with data_columns and output_table")
    parser.add_argument("data", nargs="+", help="JSON files or folders of the history")
    parser.add_argument("--zones", required=True, help="CSV with iata_code and iana_tz columns")
    parser.add_argument(
        "--no-stage",
        action="store_true",
        help="read the JSON in every pass instead of staging the prepared history as parquet once",
    )
    parser.add_argument("--schema", help="read schema as DDL; without it (or one in the config) Spark infers it")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("daybridge-bulk-load").getOrCreate()
    config = IngestConfig.from_file(args.config)
    zones = read_zones(spark, args.zones, key_col=config.utc.zone_key, zone_col=config.utc.zone_col)
    history = prepare_batch(spark, args.data, config, zones, schema=args.schema)
    staged = None
    if not args.no_stage:
        # The bulk load reads its input several times (days, time check, key
        # counts, main pass). Parse the JSON once and stage the typed history as
        # parquet in the shared scratch folder; later passes read only the
        # columns they need, and the staged files survive lost executors.
        staged = scratch_path(spark, "bulk-history")
        history.write.parquet(staged)
        history = spark.read.schema(history.schema).parquet(staged)
    try:
        bulk_load(
            history,
            config.output_table,
            config.bridge,
            location=config.table_location,
            output_partitions=config.output_partitions,
        )
    finally:
        if staged:
            free(spark, staged)
    log.info("bulk-loaded %s into %s", args.data, config.output_table)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
