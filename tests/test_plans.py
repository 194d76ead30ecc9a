"""Plan-shape checks: pruning, pushdown, broadcast and shuffle counts stay as designed."""

import contextlib
import datetime as dt
import io
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from daybridge import BridgeSpec, add_next_event, bridge_next_event
from daybridge.sources.tables import create_partitioned_table, read_partitions

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test data not present")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_next_event_is_one_exchange_and_prunes_columns(spark):
    plan = _plan(entry.q_next_event(spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_sketched_split_is_one_exchange(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    plan = _plan(add_next_event(ev, "event_type", "ts", {"u": "user_id"}, ["event_id"], strategy="split", segment_rows=200))
    # one exchange by (key, segment) feeds the window; the segments' first times come by broadcast
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "_db_seg" in plan
    assert plan.count("BroadcastExchange") == 1 and "Exchange rangepartitioning" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_split_by_ranges_reads_dealt_rows_and_broadcasts_hot_keys(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "ts", "event_type", "value")
    plan = _plan(add_next_event(ev, "event_type", "value", {"u": "user_id"}, ["event_id"], strategy="split", segment_rows=50))
    main = [line for line in plan.splitlines() if "hashpartitioning(event_type" in line and "_db_seg" in line]
    # one exchange by (key, range) feeds the window and the join, one the aggregate of first rows
    assert len(main) == 2
    assert "BroadcastExchange" in plan  # the hot-key table, size-checked
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_zone_dimension_is_broadcast(spark):
    plan = _plan(entry.q_utc_enrich(spark, SF))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "Exchange hashpartitioning" not in plan


def test_day_filter_is_pushed_to_the_scan(spark):
    plan = _plan(entry.q_filter_day(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00), LessThan(ts,2024-01-16T00:00)]" in plan


def test_previous_day_is_pruned_from_the_table(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("day", F.to_date("ts"))
    create_partitioned_table(ev, "plan_probe", "day", location=f"{tmp_dir}/plan_probe")
    prev = read_partitions(spark, "plan_probe", "day", [dt.date(2024, 1, 14)]).select(*ev.columns)
    spec = BridgeSpec(keys=("user_id",), time_col="ts", carry={"n": "event_type"}, tie_breakers=("event_id",),
                      partition_col="day", strategy="window")
    plan = _plan(bridge_next_event(ev.where(F.col("day") == dt.date(2024, 1, 15)).unionByName(prev), spec))
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan and "= 2024-01-14)]" in plan
