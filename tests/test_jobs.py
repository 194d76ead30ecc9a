"""End-to-end: the batch job entry and the drop-folder stream on flight-shaped JSON."""

import json
import time
import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from daybridge import IngestConfig, column_comments
from daybridge.jobs import bulk_load, daily_load
from daybridge.sources.tables import drop_table, table_exists
from daybridge.streaming.drop_folder import watch_folder

FLIGHT_COLUMNS = [
    {"name": "FlightDate", "type": "date", "format": "yyyy-MM-dd", "comment": "day of departure"},
    {"name": "Reporting_Airline", "type": "string", "comment": "airline"},
    {"name": "Origin", "type": "string", "comment": "where it leaves"},
    {"name": "Dest", "type": "string", "comment": "where it lands"},
    {"name": "DepTime", "type": "int", "comment": "clock on departure"},
    {"name": "Cancelled", "type": "boolean", "comment": "did not leave"},
]


def _flight(date, airline, origin, dest, dep, cancelled=False):
    return {
        "FlightDate": date,
        "carrier": {"Reporting_Airline": airline},
        "route": {"Origin": origin, "Dest": dest},
        "times": [{"DepTime": dep}],
        "Cancelled": cancelled,
    }


# The known example of the flight load - departures at 10:59 and 16:36
# local time are 15:59Z and 20220 seconds apart.
DAY1 = [
    _flight("2023-01-01", "9E", "JFK", "BOS", 1059),
    _flight("2023-01-01", "AA", "JFK", "MIA", 1636),
    _flight("2023-01-01", "DL", "JFK", "ATL", 2330),
    _flight("2023-01-01", "WN", "PHX", "LAX", 700),
    _flight("2023-01-01", "UA", "JFK", "SFO", None),
]
DAY2 = [
    _flight("2023-01-02", "B6", "JFK", "BOS", 15),
    _flight("2023-01-02", "WN", "PHX", "DEN", 2400),
]


def _write_lines(path: Path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def _setup(tmp_path):
    table = f"flights_{uuid.uuid4().hex[:8]}"
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"data_columns": FLIGHT_COLUMNS, "output_table": table, "output_partitions": 2}))
    zones = tmp_path / "zones.csv"
    zones.write_text("iata_code,iana_tz,airport\nJFK,America/New_York,Kennedy\nPHX,America/Phoenix,Sky Harbor\n")
    return table, config, zones


def test_daily_job_two_days(spark, tmp_path):
    table, config, zones = _setup(tmp_path)
    d1, d2 = tmp_path / "d1.json", tmp_path / "d2.json"
    _write_lines(d1, DAY1)
    _write_lines(d2, DAY2)
    daily_load.main([str(config), str(d1), "--zones", str(zones)])
    daily_load.main([str(config), str(d2), "--zones", str(zones)])
    rows = {(r.Reporting_Airline, str(r.FlightDate)): r for r in spark.read.table(table).collect()}
    assert len(rows) == 7
    dl = rows[("DL", "2023-01-01")]  # 23:30 EST -> 04:30Z; next JFK departure 00:15 EST -> 05:15Z
    assert dl.FlightTime == datetime(2023, 1, 2, 4, 30)
    assert (dl.Airline_next, dl.diff_next) == ("B6", 45 * 60)
    first = rows[("9E", "2023-01-01")]
    assert (first.FlightTime, first.Airline_next, first.diff_next) == (datetime(2023, 1, 1, 15, 59), "AA", 20220)
    # null clock and 2400 give null times; the null-time row is chained last
    assert rows[("UA", "2023-01-01")].FlightTime is None
    assert rows[("WN", "2023-01-02")].FlightTime is None
    # B6 (last timed JFK row of the two loaded days) chains to the null-time UA row of day 1
    assert rows[("B6", "2023-01-02")].Airline_next == "UA"
    comments = column_comments(spark, table)
    assert comments["Dest"] == "where it lands"
    cols = spark.read.table(table).columns
    assert cols[-1] == "FlightDate" and cols[-3:-1] == ["Airline_next", "diff_next"]
    assert table_exists(spark, table)
    drop_table(spark, table)
    assert not table_exists(spark, table)


def test_drop_folder_stream(spark: SparkSession, tmp_path):
    table, config_path, zones_path = _setup(tmp_path)
    config = IngestConfig.from_file(config_path)
    folder = tmp_path / "drop"
    folder.mkdir()
    _write_lines(folder / "d1.json", DAY1)
    schema = spark.read.json(str(folder)).schema
    zones = spark.read.option("header", "true").csv(str(zones_path))
    q = watch_folder(spark, str(folder), schema, config, zones, checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert spark.read.table(table).count() == 5
    _write_lines(folder / "d2.json", DAY2)
    q = watch_folder(spark, str(folder), schema, config, zones, checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    out = {(r.Reporting_Airline, str(r.FlightDate)): r for r in spark.read.table(table).collect()}
    assert len(out) == 7
    dl = out[("DL", "2023-01-01")]
    assert (dl.Airline_next, dl.diff_next) == ("B6", 45 * 60)


def test_a_day_in_two_micro_batches_and_a_restart(spark: SparkSession, tmp_path):
    table, config_path, zones_path = _setup(tmp_path)
    config = IngestConfig.from_file(config_path)
    folder = tmp_path / "drop"
    folder.mkdir()
    _write_lines(folder / "a.json", DAY1[:2])
    schema = spark.read.json(str(folder)).schema
    zones = spark.read.option("header", "true").csv(str(zones_path))

    def run():
        watch_folder(
            spark, str(folder), schema, config, zones, checkpoint_location=str(tmp_path / "ckpt")
        ).awaitTermination(120)
        return sorted((str(r.FlightDate), r.Reporting_Airline) for r in spark.read.table(table).collect())

    key = lambda rows: sorted((r["FlightDate"], r["carrier"]["Reporting_Airline"]) for r in rows)
    assert run() == key(DAY1[:2])
    _write_lines(folder / "b.json", DAY1[2:])
    assert run() == key(DAY1)
    _write_lines(folder / "c.json", DAY2)
    assert run() == key(DAY1 + DAY2)
    assert run() == key(DAY1 + DAY2)  # nothing new: a restart loads nothing again
    late = [_flight("2023-01-01", "LH", "JFK", "FRA", 1800)]
    _write_lines(folder / "late.json", late)
    assert run() == key(DAY1 + DAY2 + late)
    last = spark.read.table(table).where("Reporting_Airline = 'DL'").first()
    assert (last.Airline_next, last.diff_next) == ("B6", 45 * 60)  # the old day keeps its tail
    staged = sorted(str(p.relative_to(tmp_path / "ckpt" / "daybridge-rows")) for p in (tmp_path / "ckpt" / "daybridge-rows").glob("*/*"))
    days = [f"_db_day=2023-01-0{d}/_db_batch={b}" for d, b in ((1, 0), (1, 1), (1, 3), (2, 2))]
    assert [s for s in staged if "=" in s] == days  # a folder per day, under it one per micro-batch
    with pytest.raises(ValueError, match="checkpoint_location"):
        watch_folder(spark, str(folder), schema, config, zones, checkpoint_location="")


def test_a_micro_batch_reads_the_days_it_touches_alone(spark: SparkSession, tmp_path):
    table, config_path, zones_path = _setup(tmp_path)
    config = IngestConfig.from_file(config_path)
    folder = tmp_path / "drop"
    folder.mkdir()
    _write_lines(folder / "a.json", DAY1)
    schema = spark.read.json(str(folder)).schema
    zones = spark.read.option("header", "true").csv(str(zones_path))
    run = lambda: watch_folder(
        spark, str(folder), schema, config, zones, checkpoint_location=str(tmp_path / "ckpt")
    ).awaitTermination(120)
    run()
    for part in (tmp_path / "ckpt" / "daybridge-rows").glob("_db_day=2023-01-01/*/part-*"):
        part.write_bytes(b"not to be read")
    _write_lines(folder / "b.json", DAY2)
    run()
    assert spark.read.table(table).count() == len(DAY1) + len(DAY2)


def test_bulk_job_equals_daily_job(spark, tmp_path):
    table, config, zones = _setup(tmp_path)
    d1, d2 = tmp_path / "d1.json", tmp_path / "d2.json"
    _write_lines(d1, DAY1)
    _write_lines(d2, DAY2)
    daily_load.main([str(config), str(d1), "--zones", str(zones)])
    daily_load.main([str(config), str(d2), "--zones", str(zones)])
    daily = {(r.Reporting_Airline, str(r.FlightDate)): (r.Airline_next, r.diff_next) for r in spark.read.table(table).collect()}

    bulk_table = f"{table}_bulk"
    bulk_config = tmp_path / "bulk_config.json"
    bulk_config.write_text(config.read_text().replace(f'"{table}"', f'"{bulk_table}"'))
    bulk_load.main([str(bulk_config), str(d1), str(d2), "--zones", str(zones)])
    bulk = {(r.Reporting_Airline, str(r.FlightDate)): (r.Airline_next, r.diff_next) for r in spark.read.table(bulk_table).collect()}
    # the one-job load gives the table of the two daily loads, null-time rows included
    assert bulk == daily
    assert bulk[("DL", "2023-01-01")] == ("B6", 45 * 60)
    assert column_comments(spark, bulk_table)["Dest"] == "where it lands"
