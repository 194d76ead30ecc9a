"""Bad lines put apart, kept schemas, the zone guard, evidence of order, overwrites side by side, files by bytes."""

import glob
import json
import logging
import threading
import uuid
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daybridge import BridgeSpec, ColumnSpec, add_utc_time, bulk_load, load_day
from daybridge.jobs import daily_load
from daybridge.operators.order import order_faults
from daybridge.plans.flight_load import IngestConfig
from daybridge.sources.json_source import BadRecords, Rescue, ingest_json
from daybridge.sources.schemas import field_paths, known_schema
from daybridge.sources.tables import FileLayout, by_files, describe_table, overwrite_partitions

SPECS = [ColumnSpec("id", "int"), ColumnSpec("name", "string"), ColumnSpec("n", "int")]
SCHEMA = "id int, name string, items array<struct<n:int>>"


def _lines(tmp_path, lines, name="in.json"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def _good(i):
    return json.dumps({"id": i, "name": f"é{i}", "items": [{"n": i}, {"n": -i}]})


@pytest.mark.parametrize("schema", [SCHEMA, None])
def test_bad_lines_are_counted_and_put_apart(spark, tmp_path, schema):
    bad = ['{"id": 5, "name": "cu', "no json at all", '{"id": 7, "items": [}']
    path = _lines(tmp_path, [_good(1), bad[0], _good(2), bad[1], bad[2], _good(3)])
    apart = str(tmp_path / "apart")
    rescue = Rescue(apart, max_rows=3)
    rows = ingest_json(spark, path, SPECS, schema=schema, rescue=rescue)
    assert rows.columns == ["id", "name", "n"]
    assert sorted(tuple(r) for r in rows.collect()) == sorted((i, f"é{i}", k) for i in (1, 2, 3) for k in (i, -i))
    assert rescue.settle() == 3 and rescue.total == 6
    kept = spark.read.parquet(apart).collect()
    assert sorted(r.line for r in kept) == sorted(bad) and all(r.file.endswith("in.json") for r in kept)


def test_limits_and_no_quarantine(spark, tmp_path):
    path = _lines(tmp_path, [_good(1), "x", _good(2), "y"])
    for rescue, fails in ((Rescue(max_rows=1), True), (Rescue(max_share=0.4), True), (Rescue(max_share=0.5), False), (Rescue(), False)):
        ingest_json(spark, path, SPECS, schema=SCHEMA, rescue=rescue).collect()
        if fails:
            with pytest.raises(BadRecords, match="2 of 4"):
                rescue.settle()
        else:
            assert rescue.settle() == 2
    with pytest.raises(ValueError):
        Rescue().settle()
    clean = Rescue(str(tmp_path / "none"))
    ingest_json(spark, _lines(tmp_path, [_good(1)], "clean.json"), SPECS, schema=SCHEMA, rescue=clean).collect()
    assert clean.settle() == 0 and not (tmp_path / "none").exists()


def _flight(i, day):
    return json.dumps({"FlightDate": day, "Origin": "JFK", "DepTime": 600 + i, "Airline": f"a{i}", "id": i})


def _config(tmp_path, table, read):
    columns = [("FlightDate", "date"), ("Origin", "string"), ("DepTime", "int"), ("Airline", "string"), ("id", "int")]
    config = {
        "data_columns": [{"name": n, "type": t} | ({"format": "yyyy-MM-dd"} if t == "date" else {}) for n, t in columns],
        "output_table": table,
        "output_path": str(tmp_path / table),
        "bridge": {"carry": {"next_id": "id"}, "tie_breakers": ["id"]},
        "read": read,
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config))
    (tmp_path / "zones.csv").write_text("iata_code,iana_tz\nJFK,America/New_York\n")
    return str(path), str(tmp_path / "zones.csv")


def test_the_job_refuses_too_many_bad_lines_and_writes_nothing(spark, tmp_path, caplog):
    table = f"rescue_{uuid.uuid4().hex[:8]}"
    config, zones = _config(tmp_path, table, {"max_bad_rows": 1})
    data = _lines(tmp_path, [_flight(1, "2023-01-01"), '{"FlightDate": "2023', _flight(2, "2023-01-01"), "{"])
    schema = "FlightDate string, Origin string, DepTime int, Airline string, id int"
    with pytest.raises(BadRecords):
        daily_load.main([config, data, "--zones", zones, "--schema", schema])
    assert not spark.catalog.tableExists(table)
    apart = str(tmp_path / "apart")
    with caplog.at_level(logging.WARNING, logger="daybridge.flight_load"):
        days = daily_load.main([config, data, "--zones", zones, "--schema", schema, "--quarantine", apart, "--max-bad-share", "0.5"])
    assert days == [date(2023, 1, 1)] and "2 of 4 lines" in caplog.text
    assert spark.read.table(table).count() == 2 and spark.read.parquet(apart).count() == 2


def _jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_a_kept_schema_needs_no_second_inference(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    store = str(tmp_path / "beside" / "schema.json")
    _lines(folder, [_good(1)], "a.json")
    first = known_schema(spark, str(folder), store)
    assert sorted(field_paths(first.schema)) == ["id", "items[].n", "name"] and first.new_fields == []
    before = _jobs(spark)
    again = known_schema(spark, str(folder), store)
    assert _jobs(spark) == before and again.schema == first.schema and again.new_fields == []
    import os

    fresh = _lines(folder, ['{"id": 1.5, "extra": {"deep": [{"x": 1}]}, "items": [{"n": 1, "m": "t"}]}'], "b.json")
    later = datetime.now().timestamp() + 5
    os.utime(fresh, (later, later))
    told = known_schema(spark, str(folder), store)
    assert told.new_fields == ["extra.deep[].x", "items[].m"] and told.schema == first.schema
    before = _jobs(spark)
    assert known_schema(spark, str(folder), store).new_fields == [] and _jobs(spark) == before
    os.utime(fresh, (later + 5, later + 5))
    grown = known_schema(spark, str(folder), store, add_new=True)
    assert sorted(field_paths(grown.schema)) == ["extra.deep[].x", "id", "items[].m", "items[].n", "name"]
    assert grown.schema["id"].dataType.simpleString() == "bigint"  # a known field keeps its type
    with pytest.raises(ValueError):
        known_schema(spark, str(tmp_path / "nothing"), str(tmp_path / "other.json"))


def test_the_job_keeps_its_schema(spark, tmp_path):
    table = f"kept_{uuid.uuid4().hex[:8]}"
    config, zones = _config(tmp_path, table, {"schema_file": str(tmp_path / "schema.json")})
    for i, day in enumerate(("2023-01-01", "2023-01-02")):
        daily_load.main([config, _lines(tmp_path, [_flight(i, day)], f"{day}.json"), "--zones", zones])
    assert sorted((r.id, r.next_id) for r in spark.read.table(table).collect()) == [(0, 1), (1, None)]
    assert IngestConfig.from_file(config).read.schema_file.endswith("schema.json")


def test_zone_listed_twice(spark):
    zones = spark.createDataFrame(
        [("JFK", "America/New_York"), ("JFK", "Europe/Madrid"), ("NOZ", None), ("NOZ", "Asia/Tokyo"), (None, "UTC"), (None, "UTC")],
        "iata_code string, iana_tz string",
    )
    rows = [(1, "JFK", "2023-07-01", 1000), (2, "NOZ", "2023-07-01", 1000), (3, None, "2023-07-01", 1000)]
    df = spark.createDataFrame(rows, "id int, Origin string, FlightDate string, DepTime int")
    with pytest.raises(ValueError, match="2 keys more than once, such as 'JFK'"):
        add_utc_time(df, zones)
    for broadcast in (None, True, False):
        got = {r.id: r.FlightTime for r in add_utc_time(df, zones, as_ntz=True, on_duplicate="first", broadcast=broadcast).collect()}
        assert got == {1: datetime(2023, 7, 1, 14), 2: datetime(2023, 7, 1, 1), 3: None}
    with pytest.raises(ValueError):
        add_utc_time(df, zones, on_duplicate="any")


def test_large_dimensions_are_not_broadcast(spark, monkeypatch):
    from daybridge.operators import utc

    zones = spark.createDataFrame([("JFK", "America/New_York")], "iata_code string, iana_tz string")
    df = spark.createDataFrame([("JFK", "2023-07-01", 1000)], "Origin string, FlightDate string, DepTime int")
    plan = lambda out: out._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(add_utc_time(df, zones))
    monkeypatch.setattr(utc, "MAX_BROADCAST_ZONE_BYTES", utc.ROW_BYTES)
    assert "broadcast" not in plan(add_utc_time(df, zones))


def test_order_faults(spark):
    rows = [(i * 37 % 101, None if i % 10 == 0 else i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    found = order_faults(df.sort(F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last()), ["a", "b"], nulls_first=False).first()
    assert (found.n_rows, found.inversions) == (500, 0)
    assert order_faults(df.sort("a", "b"), ["a", "b"]).first().inversions == 0
    assert order_faults(df.sort("a", "b"), ["a", "b"], nulls_first=False).first().inversions > 0
    assert order_faults(df, ["a"]).first().inversions > 0
    # sorted inside every partition, but not over their edges
    edges = spark.range(0, 40, 1, 4).select((-F.floor(F.col("id") / 10)).alias("a"))
    assert tuple(order_faults(edges, ["a"]).first()) == (40, 3, 4)
    assert tuple(order_faults(df.where("a is null"), ["a"]).first())[:2] == (0, 0)


def test_static_and_dynamic_overwrites_side_by_side(spark):
    names = [f"side_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    rows = spark.range(40).select("id", (F.col("id") % 4).alias("p"))
    for n in names:
        rows.write.partitionBy("p").saveAsTable(n)
    errors = []

    def dynamic():
        try:
            for _ in range(4):
                overwrite_partitions(spark.range(3).select("id", F.lit(1).cast("bigint").alias("p")), names[0])
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    def static():
        try:
            for _ in range(4):
                spark.range(3).select("id", F.lit(1).cast("bigint").alias("p")).write.mode("overwrite").insertInto(names[1])
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=f) for f in (dynamic, static)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert spark.read.table(names[0]).count() == 33 and spark.read.table(names[1]).count() == 3
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_files_by_bytes_and_rows(spark, tmp_path):
    spec = BridgeSpec(keys=("k",), time_col="t", carry={"id_next": "id"}, tie_breakers=("id",), partition_col="d", heads_from_bytes=1)
    rows = [(i, "one", date(2024, 1, 1) + timedelta(days=i % 2), datetime(2024, 1, 1) + timedelta(days=i % 2, seconds=i)) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, k string, d date, t timestamp_ntz")
    files = lambda table: [len(glob.glob(f"{tmp_path}/{table}/d=2024-01-0{d}/part-*")) for d in (1, 2)]
    for layout, want in ((FileLayout(file_rows=100), [5, 5]), (FileLayout(file_rows=10_000), [1, 1])):
        table = f"files_{uuid.uuid4().hex[:8]}"
        load_day(df, table, spec, location=f"{tmp_path}/{table}", files=layout)
        assert files(table) == want and spark.read.table(table).count() == 900
        load_day(df.where("id % 2 = 1"), table, spec, files=layout)  # by heads
        assert files(table) == want and spark.read.table(table).count() == 900
        sizes = [r["count"] for r in spark.read.table(table).groupBy(F.input_file_name()).count().collect()]
        assert max(sizes) - min(sizes) <= 8
    assert FileLayout(file_bytes=1000).rows_per_file(10_000, 500) == 50
    with pytest.raises(ValueError):
        FileLayout().rows_per_file(1, 1)
    table = f"files_{uuid.uuid4().hex[:8]}"
    bulk_load(df, table, spec, location=f"{tmp_path}/{table}", files=FileLayout(file_rows=200))
    assert files(table) == [3, 3]


def test_small_files_of_several_days_share_a_task(spark, tmp_path):
    rows = [(i, date(2024, 1, 1) + timedelta(days=min(i % 40, 29))) for i in range(1200)]  # 11 times the rows in the last day
    df = spark.createDataFrame(rows, "id int, d date")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        dealt = by_files(df, "d", FileLayout(file_rows=10), "", 0)
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
    assert dealt.rdd.getNumPartitions() == 33  # the files of the last day; 120 of all days
    dealt.write.partitionBy("d").parquet(f"{tmp_path}/days")
    stored = spark.read.parquet(f"{tmp_path}/days")
    sizes = [tuple(r) for r in stored.groupBy("d", F.input_file_name()).count().select("d", "count").collect()]
    assert sorted(r.id for r in stored.collect()) == list(range(1200))
    assert Counter(d for d, _ in sizes) == {date(2024, 1, 1) + timedelta(days=k): 33 if k == 29 else 3 for k in range(30)}
    assert max(n for _, n in sizes) <= 20


def test_table_description(spark, tmp_path):
    table = f"told_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, "x", date(2024, 1, 1))], "a int, b string, d date")
    df = df.withMetadata("a", {"comment": "a number"})
    df.write.partitionBy("d").option("path", f"{tmp_path}/{table}").saveAsTable(table)
    got = [tuple(r) for r in describe_table(spark, table).drop("location").collect()]
    assert got == [
        ("a", "int", "a number", False, "parquet", "EXTERNAL"),
        ("b", "string", None, False, "parquet", "EXTERNAL"),
        ("d", "date", None, True, "parquet", "EXTERNAL"),
    ]
    assert describe_table(spark, table).first().location.endswith(table)
