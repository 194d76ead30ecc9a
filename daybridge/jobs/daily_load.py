"""Batch entry point: load one day's JSON file into the flight table.

    spark-submit --py-files daybridge.zip daybridge/jobs/daily_load.py CONFIG.json DATA.json --zones ZONES.csv

Session settings (metastore, warehouse, checkpoint folder) come from
spark-submit; this module only reads the config and runs the load.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from daybridge.plans.flight_load import IngestConfig, process_file
from daybridge.sources.json_source import Rescue

log = logging.getLogger("daybridge.daily_load")


def main(argv: list[str] | None = None) -> list:
    parser = argparse.ArgumentParser(description="Load one JSON batch into a date-partitioned table.")
    parser.add_argument("config", help="JSON config with data_columns and output_table")
    parser.add_argument("data", nargs="+", help="JSON file(s) of the batch")
    parser.add_argument("--zones", required=True, help="CSV with iata_code and iana_tz columns")
    parser.add_argument(
        "--lookahead-days",
        type=int,
        default=0,
        help="when reloading an old day, also read this many later days as successor candidates",
    )
    parser.add_argument("--merge", action="store_true", help="add the rows to days the table has instead of replacing them")
    parser.add_argument("--quarantine", help="folder for lines that cannot be read (they are rows of nulls if no option says otherwise)")
    parser.add_argument("--max-bad-rows", type=int, help="fail, and write nothing, if more lines than this cannot be read")
    parser.add_argument("--max-bad-share", type=float, help="the same, as a share of all lines")
    parser.add_argument("--schema", help="read schema as DDL; without it (or one in the config) Spark infers it")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("daybridge-daily-load").getOrCreate()
    config = IngestConfig.from_file(args.config)
    given = (args.quarantine, args.max_bad_rows, args.max_bad_share)
    rescue = config.read.rescue() if given == (None, None, None) else Rescue(*given)
    days = process_file(
        spark,
        args.data,
        config,
        args.zones,
        schema=args.schema,
        lookahead_days=args.lookahead_days,
        merge=args.merge,
        rescue=rescue,
    )
    log.info("loaded %s into %s", [str(d) for d in days], config.output_table)
    if rescue is not None:
        log.info("%s of %s lines could not be read", rescue.bad, rescue.total)
    return days


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
