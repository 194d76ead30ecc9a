"""

``entry(spark)`` runs the flagship query (next event per user) on sf0.001.
``queries()`` holds one Spark query per operator of the inventory, each reading
the given tables whole; ``oracle_sql()`` the same result as DuckDB SQL over the
"""

from __future__ import annotations

import datetime as dt
import json
import sys
import tempfile
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The package sits next to this file; make it importable however this module is loaded.
_HERE = str(Path(__file__).resolve().parent)
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from daybridge.operators.flatten import flatten  # noqa: E402
from daybridge.operators.next_event import add_next_event  # noqa: E402
from daybridge.operators.order import order_faults  # noqa: E402
from daybridge.operators.project import ColumnSpec, project_typed  # noqa: E402
from daybridge.operators.utc import add_utc_time  # noqa: E402
from daybridge.jobs import daily_load  # noqa: E402
from daybridge.plans.daily import BridgeSpec, bulk_bridge, bulk_load, load_day  # noqa: E402
from daybridge.sources.json_source import Rescue, ingest_json  # noqa: E402
from daybridge.sources.scratch import materialize, scratch_path, unique_table_name  # noqa: E402
from daybridge.sources.tables import (  # noqa: E402
    FileLayout,
    create_partitioned_table,
    describe_table,
    drop_table,
    overwrite_partitions,
    table_exists,
)
from daybridge.sources.zones import read_zones  # noqa: E402

# ---------------------------------------------------------------------------
# Fixed values shared by the Spark queries and their SQL oracles.
# Zone dimension of the UTC queries: order priority plays the airport code.
ZONE_ROWS = [
    ("1-URGENT", "America/New_York"),
    ("2-HIGH", "Asia/Tokyo"),
    ("3-MEDIUM", "Europe/Madrid"),
    ("4-NOT SPECIFIED", None),
    ("PHX", "America/Phoenix"),
]
# Zone dimension of json_daily_load: the event type plays the airport code.
EVENT_ZONE_ROWS = [
    ("view", "America/New_York"),
    ("click", "Asia/Tokyo"),
    ("error", "Europe/Madrid"),
    ("purchase", None),
]
FILTER_DAY = dt.date(2024, 1, 15)  # day selected / replaced / reloaded in the event queries
SPLIT_DAY = dt.date(2024, 1, 16)  # first day of the second half in union_days
HOT_SEGMENT_ROWS = 500  # segment size of next_event_hot_keys (every event type is a hot key)
HEADS_FROM = dt.date(2024, 1, 25)  # first day that daily_heads loads by itself
BROKEN = 50  # every such event is a broken line in json_rescue
FILE_ROWS = 250  # rows of a file in files_per_day
TOP_USER = 1  # user of top1_next_event
ONE_ORIGIN = "2-HIGH"  # airport of first_departure and departures_sorted
LATE_CLOCK = 1200  # departures_sorted keeps clocks from here on
BACKFILL = (dt.date(2024, 1, 11), dt.date(2024, 1, 20))  # days of bulk_backfill that come last
# Further rows of the zone dimension of zone_guard; none of their zones comes before the first one by name.
ZONES_AGAIN = [("1-URGENT", "Europe/Madrid"), ("2-HIGH", "Asia/Tokyo"), ("2-HIGH", "Europe/Madrid"), (None, "UTC")]
# Hours by which batch_any_times moves the events of a type, as far zones do.
SHIFT_HOURS = {"view": -10, "click": 13, "error": 5, "purchase": 0}
# ---------------------------------------------------------------------------

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENT_SPEC = BridgeSpec(
    keys=("user_id",),
    time_col="ts",
    carry={"event_type_next": "event_type"},
    tie_breakers=("event_id",),
    partition_col="day",
)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


# --- next event -------------------------------------------------------------


def q_next_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return add_next_event(ev, "user_id", "ts", {"event_type_next": "event_type"}, ["event_id"])


def q_next_event_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("ts")).alias("ts"),
        "event_type",
    )
    return add_next_event(ev, "user_id", "ts", {"event_type_next": "event_type"}, ["event_id"])


def q_next_event_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return add_next_event(
        ev, "event_type", "ts", {"user_id_next": "user_id"}, ["event_id"], segment_rows=HOT_SEGMENT_ROWS
    )


def q_next_event_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times cut to the day, no tie-breaker, five hot keys: every row but the last of a key is a successor once."""
    ev = _t(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"), "event_type")
    out = add_next_event(ev, "event_type", "day", {"event_id_next": "event_id"}, segment_rows=HOT_SEGMENT_ROWS)
    return _successors(out)


def q_next_event_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null key holds every event that is no purchase: it is dealt to ranges like any hot key."""
    ev = _t(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("buyer")
    )
    return add_next_event(
        ev, "buyer", "ts", {"event_id_next": "event_id"}, ["event_id"], segment_rows=HOT_SEGMENT_ROWS
    )


def q_bulk_null_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day, no times, no tie-breaker, through the bulk path: one chain per key."""
    ev = _t(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.lit(FILTER_DAY).alias("day"),
    )
    spec = BridgeSpec(
        keys=("event_type",),
        time_col="ts",
        carry={"event_id_next": "event_id"},
        partition_col="day",
        segment_rows=HOT_SEGMENT_ROWS,
    )
    return _successors(bulk_bridge(ev, spec))


def _successors(linked: DataFrame) -> DataFrame:
    return linked.agg(
        F.count("event_id_next").alias("successors"), F.count_distinct("event_id_next").alias("distinct_successors")
    )


def q_top1_next_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of one user, times as text."""
    one = q_next_event(spark, sf_dir).where(F.col("user_id") == TOP_USER)
    text = one.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("ts", "ts_next")})
    return text.orderBy(F.col("ts").asc(), F.col("event_id").asc()).limit(1)


# --- flatten, typing, JSON ingest ---------------------------------------------


def q_flatten_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_t(spark, sf_dir, "embeddings"))


def q_flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    nested = o.select(
        F.struct("o_orderkey", "o_custkey").alias("ids"),
        F.struct("o_orderstatus", F.struct("o_orderpriority", "o_totalprice").alias("detail")).alias("info"),
        F.create_map(F.lit("cust"), F.col("o_custkey")).alias("tags"),
        F.array(
            F.struct(F.lit("ordered").alias("stage"), F.col("o_orderdate").alias("at")),
            F.struct(F.lit("due").alias("stage"), (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("at")),
        ).alias("stages"),
    )
    return flatten(nested)


LINE_SPECS = [
    ColumnSpec("orderkey", "bigint", comment="order key"),
    ColumnSpec("linenumber", "int", comment="line number within the order"),
    ColumnSpec("ship_day", "date", "yyyy-MM-dd", "ship date"),
    ColumnSpec("returned", "boolean", comment="return flag is R"),
    ColumnSpec("measure", "string", comment="what the amount measures"),
    ColumnSpec("amount", "double", comment="quantity or extended price"),
]


def q_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    nested = li.select(
        F.struct(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber")).alias("id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.array(
            F.struct(F.lit("qty").alias("measure"), F.col("l_quantity").alias("amount")),
            F.struct(F.lit("price").alias("measure"), F.col("l_extendedprice").alias("amount")),
        ).alias("measures"),
    )
    path = scratch_path(spark, "json-ingest")
    nested.write.json(path)
    return ingest_json(spark, path, LINE_SPECS)


RESCUE_SPECS = [
    ColumnSpec("event_id", "bigint", comment="event id"),
    ColumnSpec("user_id", "bigint", comment="user"),
    ColumnSpec("event_type", "string", comment="kind of event"),
    ColumnSpec("value", "double", comment="event value"),
]


def q_json_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of which every 50th is cut in half: the rows of the good ones, and how many lines were put apart."""
    ev = _t(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "user_id", F.struct("event_type", "value").alias("detail")))
    half = F.substring(line, F.lit(1), (F.length(line) / 2).cast("int"))
    path, apart = scratch_path(spark, "json-broken"), scratch_path(spark, "json-quarantine")
    ev.select(F.when(F.col("event_id") % BROKEN == 0, half).otherwise(line).alias("value")).write.text(path)
    rescue = Rescue(apart, max_share=0.1)
    rows = materialize(ingest_json(spark, path, RESCUE_SPECS, schema=RESCUE_SCHEMA, rescue=rescue), "rescued")
    rescue.settle()
    lines = spark.read.parquet(apart).agg(F.count("line").alias("lines_apart"))
    return rows.withColumn("bad_lines", F.lit(rescue.bad).cast("long")).crossJoin(F.broadcast(lines))  # a single row


RESCUE_SCHEMA = "event_id bigint, user_id bigint, detail struct<event_type:string,value:double>"

ORDER_SPECS = [
    ColumnSpec("o_orderkey", "bigint", comment="order key"),
    ColumnSpec("o_custkey", "int", comment="customer key"),
    ColumnSpec("o_orderdate", "date", "dd/MM/yyyy", "order date"),
    ColumnSpec("o_totalprice", "double", comment="total price"),
    ColumnSpec("o_fulfilled", "boolean", comment="status is F"),
    ColumnSpec("o_orderpriority", "string"),
]


def q_typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    as_text = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "F", "true")
        .when(F.col("o_orderstatus").isNotNull(), "false")
        .alias("o_fulfilled"),
        F.col("o_orderpriority"),
        F.col("o_orderstatus"),  # not configured: dropped by the projection
    )
    return project_typed(as_text, ORDER_SPECS)


# --- UTC enrichment -----------------------------------------------------------


def _zones(spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "zones-csv")
    spark.createDataFrame(ZONE_ROWS, "iata_code string, iana_tz string").coalesce(1).write.option(
        "header", "true"
    ).csv(path)
    return read_zones(spark, path)


def _order_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as departures: priority plays the airport, the clock is derived from the
    key so that valid times, 2400 and above, and minutes of 60+ all occur; no clock
    for pending orders."""
    o = _t(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("FlightDate"),
        F.col("o_orderpriority").alias("Origin"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .otherwise((F.col("o_orderkey") * 7) % 2461)
        .alias("DepTime"),
    )


def q_utc_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_utc_time(_order_departures(spark, sf_dir), _zones(spark), as_ntz=True)


def q_zone_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone dimension that lists airports twice doubles no departure: the zone that comes first by name counts."""
    twice = spark.createDataFrame([*ZONE_ROWS, *ZONES_AGAIN], "iata_code string, iana_tz string")
    return add_utc_time(_order_departures(spark, sf_dir), twice, as_ntz=True, on_duplicate="first")


def q_departures_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of a global sort, nulls last: no row of all departures stands behind a later one."""
    out = q_utc_next_departure(spark, sf_dir).sort(F.col("Origin").asc_nulls_last(), F.col("FlightTime").asc_nulls_last())
    return order_faults(out, ["Origin", "FlightTime"], nulls_first=False).select("n_rows", "inversions")


def q_null_time_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_utc_enrich(spark, sf_dir).where("FlightTime IS NULL").agg(F.count(F.lit(1)).alias("null_times"))


def q_first_departure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, then minimum, then text."""
    one = q_utc_enrich(spark, sf_dir).where(F.col("Origin") == ONE_ORIGIN)
    return one.select(F.min("FlightTime").cast("string").alias("first_departure"))


def q_utc_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default, instant-typed departure, as epoch seconds."""
    out = add_utc_time(_order_departures(spark, sf_dir), _zones(spark))
    return out.withColumn("FlightTime", F.unix_seconds("FlightTime"))


def q_departures_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sort by two columns and an SQL predicate of two conditions on the whole departures."""
    out = q_utc_next_departure(spark, sf_dir).sort("Origin", "FlightTime")
    return out.where(f"Origin = '{ONE_ORIGIN}' and DepTime >= {LATE_CLOCK}")


def q_utc_next_departure(spark: SparkSession, sf_dir: str) -> DataFrame:
    utc = q_utc_enrich(spark, sf_dir)
    return add_next_event(utc, "Origin", "FlightTime", {"orderkey_next": "o_orderkey"}, ["o_orderkey"])


# --- filters, unions, tables, daily load ---------------------------------------


def q_filter_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit(f"{FILTER_DAY.isoformat()} 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{(FILTER_DAY + dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    # A range on the raw column is pushed into the parquet scan (row-group skipping).
    return _t(spark, sf_dir, "events").where((F.col("ts") >= start) & (F.col("ts") < end))


def q_union_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir)
    first = ev.where(F.col("day") < F.lit(SPLIT_DAY)).select(*EVENT_COLS)
    second = ev.where(F.col("day") >= F.lit(SPLIT_DAY)).select(*reversed(EVENT_COLS))
    return first.unionByName(second, allowMissingColumns=False)


def _scratch_table(spark: SparkSession, label: str) -> tuple[str, str]:
    return unique_table_name(label), scratch_path(spark, label)


def q_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir)
    table, location = _scratch_table(spark, "events_by_day")
    create_partitioned_table(ev, table, "day", location=location)
    replaced = spark.read.table(table).where(F.col("day") == F.lit(FILTER_DAY))
    overwrite_partitions(replaced.withColumn("value", F.col("value") * 2), table)
    return spark.read.table(table)


def q_daily_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir)
    table, location = _scratch_table(spark, "events_daily")
    days = [r[0] for r in ev.select("day").distinct().orderBy("day").collect()]
    for day in days:
        load_day(ev.where(F.col("day") == F.lit(day)), table, EVENT_SPEC, location=location)
    return spark.read.table(table)


def q_reload_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_by_day(spark, sf_dir)
    table, location = _scratch_table(spark, "events_reload")
    bulk_load(ev, table, EVENT_SPEC, location=location)
    load_day(ev.where(F.col("day") == F.lit(FILTER_DAY)), table, EVENT_SPEC)
    return spark.read.table(table)


def q_bulk_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulk_bridge(_events_by_day(spark, sf_dir), EVENT_SPEC)


def q_bulk_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle of a history comes last and joins on both sides."""
    ev = _events_by_day(spark, sf_dir)
    table, location = _scratch_table(spark, "events_backfill")
    middle = F.col("day").between(*(F.lit(d) for d in BACKFILL))
    bulk_load(ev.where(~middle), table, EVENT_SPEC, location=location)
    bulk_load(ev.where(middle), table, EVENT_SPEC)
    return spark.read.table(table)


def q_merge_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day comes in two parts; the second is added to what the table has."""
    ev = _events_by_day(spark, sf_dir)
    table, location = _scratch_table(spark, "events_halves")
    first = F.col("event_type").isin("view", "error")
    load_day(ev.where(first), table, EVENT_SPEC, location=location)
    load_day(ev.where(~first), table, EVENT_SPEC, merge=True)
    return spark.read.table(table)


def q_batch_any_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch of all days whose times do not advance with the day: every two-day union is chained for itself."""
    shift = F.create_map(*(F.lit(x) for pair in SHIFT_HOURS.items() for x in pair))
    ev = _events_by_day(spark, sf_dir).select(
        "event_id",
        "user_id",
        "event_type",
        (F.col("ts") + F.make_dt_interval(hours=F.coalesce(shift[F.col("event_type")], F.lit(0)))).alias("moved"),
        "day",
    )
    table, location = _scratch_table(spark, "events_shifted")
    spec = BridgeSpec(
        keys=("user_id",),
        time_col="moved",
        carry={"event_id_next": "event_id"},
        tie_breakers=("event_id",),
        partition_col="day",
    )
    load_day(ev, table, spec, location=location)
    return spark.read.table(table)


def q_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty batch leaves the table as it is."""
    ev = _events_by_day(spark, sf_dir)
    table, location = _scratch_table(spark, "events_empty")
    bulk_load(ev, table, EVENT_SPEC, location=location)
    load_day(ev.where("event_id is null"), table, EVENT_SPEC)
    return spark.read.table(table)


def q_table_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's description of a table made from orders, with the number of values of each column."""
    typed = q_typed_projection(spark, sf_dir)
    table, location = _scratch_table(spark, "orders_commented")
    create_partitioned_table(typed, table, "o_orderpriority", location=location)
    stored = spark.read.table(table)
    counts = stored.select(*(F.count(c).alias(c) for c in stored.columns))
    counts = counts.unpivot([], stored.columns, "column_name", "n_values")
    return describe_table(spark, table).drop("location").join(counts, "column_name")


def q_daily_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history, then day by day: each day's first rows go to the open ends of the day before, which is not sorted."""
    ev = _events_by_day(spark, sf_dir)
    table, location = _scratch_table(spark, "events_heads")
    spec = replace(EVENT_SPEC, heads_from_bytes=1)
    bulk_load(ev.where(F.col("day") < F.lit(HEADS_FROM)), table, spec, location=location)
    late = ev.where(F.col("day") >= F.lit(HEADS_FROM))
    for day in [r[0] for r in late.select("day").distinct().orderBy("day").collect()]:
        load_day(late.where(F.col("day") == F.lit(day)), table, spec)
    return spark.read.table(table)


def q_files_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows of every day after a load with a set number of rows per file."""
    table, location = _scratch_table(spark, "events_files")
    ev = _events_by_day(spark, sf_dir)
    load_day(ev, table, EVENT_SPEC, location=location, files=FileLayout(file_rows=FILE_ROWS))
    placed = spark.read.table(table).select("day", F.input_file_name().alias("file"))
    return placed.groupBy("day").agg(F.count_distinct("file").alias("files"), F.count("*").alias("n_rows"))


def q_dropped_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scratch table is made, counted and dropped; afterwards the catalog does not have it."""
    table, location = _scratch_table(spark, "events_dropped")
    create_partitioned_table(_events_by_day(spark, sf_dir), table, "day", location=location)
    rows = spark.read.table(table).count()
    drop_table(spark, table)
    return spark.createDataFrame([(rows, table_exists(spark, table))], "n_rows long, still_there boolean")


EVENT_JSON_COLUMNS = [
    {"name": "FlightDate", "type": "date", "format": "yyyy-MM-dd", "comment": "departure date"},
    {"name": "event_id", "type": "bigint", "comment": "event id"},
    {"name": "Origin", "type": "string", "comment": "origin code"},
    {"name": "DepTime", "type": "int", "comment": "local departure clock HHmm"},
    {"name": "user_id", "type": "bigint", "comment": "user"},
    {"name": "value", "type": "double", "comment": "event value"},
]
EVENT_JSON_SCHEMA = (
    "FlightDate string, flight struct<event_id:bigint,Origin:string>, "
    "times struct<DepTime:int,detail:struct<user_id:bigint,value:double>>"
)


def q_json_daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files -> daily load job, called twice with an explicit schema -> table.

    Events play flights: the event type is the airport, the event's wall clock
    (HHmm) the local departure time, its date the flight date. The second call
    reads the last day of the first back and bridges it.
    """
    ev = _events_by_day(spark, sf_dir)
    nested = ev.select(
        "day",
        F.date_format("ts", "yyyy-MM-dd").alias("FlightDate"),
        F.struct("event_id", F.col("event_type").alias("Origin")).alias("flight"),
        F.struct(
            (F.hour("ts") * 100 + F.minute("ts")).alias("DepTime"),
            F.struct("user_id", "value").alias("detail"),
        ).alias("times"),
    )
    table, location = _scratch_table(spark, "event_flights")
    zones = scratch_path(spark, "event-zones")
    spark.createDataFrame(EVENT_ZONE_ROWS, "iata_code string, iana_tz string").coalesce(1).write.option(
        "header", "true"
    ).csv(zones)
    config = Path(tempfile.mkdtemp(prefix="daybridge-config-")) / "config.json"  # read on the driver alone
    config.write_text(
        json.dumps(
            {
                "data_columns": EVENT_JSON_COLUMNS,
                "output_table": table,
                "output_path": location,
                "utc": {"as_ntz": True},
                "bridge": {
                    "keys": ["Origin"],
                    "time_col": "FlightTime",
                    "carry": {"user_next": "user_id"},
                    "tie_breakers": ["event_id"],
                    "partition_col": "FlightDate",
                },
                "read": {"schema": EVENT_JSON_SCHEMA},
            }
        )
    )
    for half in (F.col("day") < F.lit(SPLIT_DAY), F.col("day") >= F.lit(SPLIT_DAY)):
        path = scratch_path(spark, "events-json")
        nested.where(half).drop("day").write.json(path)
        daily_load.main([str(config), path, "--zones", zones])
    return spark.read.table(table)


def entry(spark: SparkSession) -> DataFrame:
    return q_next_event(spark, "/root/testdata/sf0.001")


def _added() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the optional subpackage and of the corpus pipeline, where they can be imported."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    sql: dict[str, str] = {}
    try:
        from daybridge.llm import queries as added
    except ImportError:
        return found, sql
    found |= added.queries()
    sql |= added.oracle_sql()
    try:
        import corpus_pipeline
    except ImportError:
        return found, sql
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | _added()[0]


def oracle_sql() -> dict[str, str]:
    return _own_sql() | _added()[1]


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "next_event": q_next_event,
        "next_event_nulls": q_next_event_nulls,
        "next_event_hot_keys": q_next_event_hot_keys,
        "next_event_ties": q_next_event_ties,
        "next_event_null_key": q_next_event_null_key,
        "top1_next_event": q_top1_next_event,
        "daily_heads": q_daily_heads,
        "files_per_day": q_files_per_day,
        "json_rescue": q_json_rescue,
        "zone_guard": q_zone_guard,
        "departures_order": q_departures_order,
        "flatten_array": q_flatten_array,
        "flatten_nested": q_flatten_nested,
        "json_ingest": q_json_ingest,
        "typed_projection": q_typed_projection,
        "utc_enrich": q_utc_enrich,
        "null_time_count": q_null_time_count,
        "first_departure": q_first_departure,
        "utc_instant": q_utc_instant,
        "departures_sorted": q_departures_sorted,
        "utc_next_departure": q_utc_next_departure,
        "filter_day": q_filter_day,
        "union_days": q_union_days,
        "partition_overwrite": q_partition_overwrite,
        "daily_bridge": q_daily_bridge,
        "reload_day": q_reload_day,
        "bulk_bridge": q_bulk_bridge,
        "bulk_null_ties": q_bulk_null_ties,
        "bulk_backfill": q_bulk_backfill,
        "merge_halves": q_merge_halves,
        "batch_any_times": q_batch_any_times,
        "empty_batch": q_empty_batch,
        "table_comments": q_table_comments,
        "dropped_table": q_dropped_table,
        "json_daily_load": q_json_daily_load,
    }


# --- SQL oracles ----------------------------------------------------------------

_GAP = "(epoch_us(LEAD({t}) OVER w) - epoch_us({t})) // 1000000"

_NEXT_EVENT_SQL = f"""
SELECT event_id, user_id, ts, event_type,
       LEAD(ts) OVER w AS ts_next,
       LEAD(event_type) OVER w AS event_type_next,
       {_GAP.format(t="ts")} AS diff_next
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_id ASC)
"""

_ZONES_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {'NULL' if z is None else repr(z)})" for k, z in ZONE_ROWS
) + ") AS z(iata_code, iana_tz)"

_EVENT_ZONES_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {'NULL' if z is None else repr(z)})" for k, z in EVENT_ZONE_ROWS
) + ") AS z(iata_code, iana_tz)"

_DEPARTURES_SQL = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS FlightDate, o_orderpriority AS Origin,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE (o_orderkey * 7) % 2461 END AS DepTime
FROM orders
"""

_LOCAL_CLOCK_SQL = (
    "try_strptime(CAST(f.FlightDate AS VARCHAR) || ' ' || lpad(CAST(f.DepTime AS VARCHAR), 4, '0'), '%Y-%m-%d %H%M')"
)



def _utc_instant_sql(local: str, zone: str) -> str:
    """UTC wall clock of a local clock in a zone, resolving DST overlaps like Spark.

    java.time (Spark) gives an ambiguous wall clock the earlier offset, DuckDB the
    later one; when the instant one hour earlier shows the same wall clock, take it.
    """
    later = f"timezone({zone}, {local})"
    earlier = f"({later} - INTERVAL 1 HOUR)"
    return (
        f"CAST(timezone('UTC', CASE WHEN timezone({zone}, {earlier}) = {local} THEN {earlier} ELSE {later} END)"
        " AS TIMESTAMP)"
    )


_UTC_SQL = f"""
SELECT f.o_orderkey, f.FlightDate, f.Origin, f.DepTime,
       {_utc_instant_sql(_LOCAL_CLOCK_SQL, "z.iana_tz")} AS FlightTime
FROM ({_DEPARTURES_SQL}) AS f
LEFT JOIN ({_ZONES_SQL}) AS z ON f.Origin = z.iata_code
"""

_UTC_NEXT_SQL = f"""
SELECT o_orderkey, FlightDate, Origin, DepTime, FlightTime,
       LEAD(FlightTime) OVER w AS FlightTime_next,
       LEAD(o_orderkey) OVER w AS orderkey_next,
       {_GAP.format(t="FlightTime")} AS diff_next
FROM ({_UTC_SQL})
WINDOW w AS (PARTITION BY Origin ORDER BY FlightTime ASC NULLS LAST, o_orderkey ASC)
"""

# Every row of a key but the last has a successor, and no row is a successor twice.
_CHAIN_SQL = """
SELECT COUNT(*) - COUNT(DISTINCT event_type) AS successors,
       COUNT(*) - COUNT(DISTINCT event_type) AS distinct_successors
FROM events
"""

# Loads in ascending order, each over a day and the day before: a row keeps what
# the load of the next day gave it, or its own day's load where no next day is.
_UNIONS_SQL = f"""
WITH e AS (
  SELECT event_id, user_id, event_type,
         ts + to_hours(CASE event_type {" ".join(f"WHEN '{k}' THEN {v}" for k, v in SHIFT_HOURS.items())} ELSE 0 END) AS moved,
         CAST(ts AS DATE) AS day
  FROM events),
d AS (SELECT DISTINCT day FROM e),
o AS (SELECT d.day, CASE WHEN n.day IS NULL THEN d.day ELSE n.day END AS taken
      FROM d LEFT JOIN d AS n ON n.day = d.day + 1),
u AS (SELECT e.*, l.taken, l.taken = o.taken AS mine
      FROM e JOIN o ON o.day = e.day JOIN (SELECT DISTINCT taken FROM o) AS l ON l.taken IN (e.day, e.day + 1))
SELECT event_id, user_id, event_type, moved, moved_next, event_id_next, diff_next, day
FROM (
  SELECT *, LEAD(moved) OVER w AS moved_next, LEAD(event_id) OVER w AS event_id_next, {_GAP.format(t="moved")} AS diff_next
  FROM u
  WINDOW w AS (PARTITION BY user_id, taken ORDER BY moved ASC NULLS LAST, event_id ASC)
)
WHERE mine
"""

# Day-by-day loading in ascending order: the successor over the whole history,
# kept only when it lies on the same or the next day.
_CLOSED_FORM_SQL = """
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN keep THEN nts END AS ts_next,
       CASE WHEN keep THEN nty END AS event_type_next,
       CASE WHEN keep THEN (epoch_us(nts) - epoch_us(ts)) // 1000000 END AS diff_next,
       day
FROM (
  SELECT *, (nd IS NULL OR nd <= day + 1{extra}) AS keep
  FROM (
    SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS day,
           LEAD(ts) OVER w AS nts, LEAD(event_type) OVER w AS nty, LEAD(CAST(ts AS DATE)) OVER w AS nd
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_id ASC)
  )
)
"""


def _own_sql() -> dict[str, str]:
    day = FILTER_DAY.isoformat()
    return {
        "next_event": _NEXT_EVENT_SQL,
        "next_event_nulls": f"""
            WITH e AS (
              SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts, event_type
              FROM events)
            SELECT event_id, user_id, ts, event_type,
                   LEAD(ts) OVER w AS ts_next,
                   LEAD(event_type) OVER w AS event_type_next,
                   {_GAP.format(t="ts")} AS diff_next
            FROM e
            WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_id ASC)
        """,
        "next_event_hot_keys": f"""
            SELECT event_id, user_id, ts, event_type,
                   LEAD(ts) OVER w AS ts_next,
                   LEAD(user_id) OVER w AS user_id_next,
                   {_GAP.format(t="ts")} AS diff_next
            FROM events
            WINDOW w AS (PARTITION BY event_type ORDER BY ts ASC NULLS LAST, event_id ASC)
        """,
        "next_event_ties": _CHAIN_SQL,
        "bulk_null_ties": _CHAIN_SQL,
        "next_event_null_key": f"""
            WITH e AS (
              SELECT event_id, ts, CASE WHEN event_type = 'purchase' THEN user_id END AS buyer FROM events)
            SELECT event_id, ts, buyer,
                   LEAD(ts) OVER w AS ts_next,
                   LEAD(event_id) OVER w AS event_id_next,
                   {_GAP.format(t="ts")} AS diff_next
            FROM e
            WINDOW w AS (PARTITION BY buyer ORDER BY ts ASC NULLS LAST, event_id ASC)
        """,
        "top1_next_event": f"""
            SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type,
                   strftime(ts_next, '%Y-%m-%d %H:%M:%S') AS ts_next, event_type_next, diff_next
            FROM (SELECT * FROM ({_NEXT_EVENT_SQL}) WHERE user_id = {TOP_USER} ORDER BY ts ASC, event_id ASC LIMIT 1)
        """,
        "flatten_array": "SELECT vec_id, UNNEST(embedding) AS embedding, label FROM embeddings",
        "flatten_nested": """
            SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
                   'ordered' AS stage, o_orderdate AS at
            FROM orders
            UNION ALL
            SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
                   'due' AS stage, o_orderdate + INTERVAL 30 DAY AS at
            FROM orders
        """,
        "json_ingest": """
            SELECT l_orderkey AS orderkey, CAST(l_linenumber AS INTEGER) AS linenumber,
                   CAST(l_shipdate AS DATE) AS ship_day, l_returnflag = 'R' AS returned,
                   'qty' AS measure, l_quantity AS amount
            FROM lineitem
            UNION ALL
            SELECT l_orderkey, CAST(l_linenumber AS INTEGER), CAST(l_shipdate AS DATE), l_returnflag = 'R',
                   'price', l_extendedprice
            FROM lineitem
        """,
        "typed_projection": """
            SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
                   o_totalprice, o_orderstatus = 'F' AS o_fulfilled, o_orderpriority
            FROM orders
        """,
        "utc_enrich": _UTC_SQL,
        "null_time_count": f"SELECT COUNT(*) AS null_times FROM ({_UTC_SQL}) WHERE FlightTime IS NULL",
        "first_departure": f"""
            SELECT strftime(MIN(FlightTime), '%Y-%m-%d %H:%M:%S') AS first_departure
            FROM ({_UTC_SQL}) WHERE Origin = '{ONE_ORIGIN}'
        """,
        "utc_instant": f"""
            SELECT o_orderkey, FlightDate, Origin, DepTime, CAST(epoch_us(FlightTime) // 1000000 AS BIGINT) AS FlightTime
            FROM ({_UTC_SQL})
        """,
        "departures_sorted": f"SELECT * FROM ({_UTC_NEXT_SQL}) WHERE Origin = '{ONE_ORIGIN}' AND DepTime >= {LATE_CLOCK}",
        "utc_next_departure": _UTC_NEXT_SQL,
        "filter_day": f"""
            SELECT * FROM events
            WHERE ts >= TIMESTAMP '{day} 00:00:00' AND ts < TIMESTAMP '{day} 00:00:00' + INTERVAL 1 DAY
        """,
        "union_days": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "partition_overwrite": f"""
            SELECT event_id, ts, user_id, event_type,
                   CASE WHEN CAST(ts AS DATE) = DATE '{day}' THEN value * 2 ELSE value END AS value,
                   props, CAST(ts AS DATE) AS day
            FROM events
        """,
        "daily_bridge": _CLOSED_FORM_SQL.format(extra=""),
        "reload_day": _CLOSED_FORM_SQL.format(extra=f" AND NOT (day = DATE '{day}' AND nd > day)"),
        "bulk_bridge": _CLOSED_FORM_SQL.format(extra=""),
        "bulk_backfill": _CLOSED_FORM_SQL.format(extra=""),
        "merge_halves": _CLOSED_FORM_SQL.format(extra=""),
        "empty_batch": _CLOSED_FORM_SQL.format(extra=""),
        "batch_any_times": _UNIONS_SQL,
        "dropped_table": "SELECT COUNT(*) AS n_rows, FALSE AS still_there FROM events",
        "table_comments": "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c.name}' AS column_name, '{c.type}' AS data_type, {c.comment!r} AS column_comment, "
            f"{c.name == 'o_orderpriority'} AS is_partition, 'parquet' AS provider, 'EXTERNAL' AS table_kind, "
            f"COUNT({'o_orderstatus' if c.name == 'o_fulfilled' else c.name}) AS n_values FROM orders"
            for c in ORDER_SPECS
        ) + ")",
        "daily_heads": _CLOSED_FORM_SQL.format(extra=""),
        "files_per_day": f"""
            SELECT CAST(ts AS DATE) AS day, (COUNT(*) + {FILE_ROWS} - 1) // {FILE_ROWS} AS files, COUNT(*) AS n_rows
            FROM events GROUP BY 1
        """,
        "json_rescue": f"""
            SELECT event_id, user_id, event_type, value, n AS bad_lines, n AS lines_apart
            FROM events, (SELECT COUNT(*) AS n FROM events WHERE event_id % {BROKEN} = 0)
            WHERE event_id % {BROKEN} <> 0
        """,
        "zone_guard": _UTC_SQL,
        "departures_order": f"SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS inversions FROM ({_UTC_NEXT_SQL})",
        "json_daily_load": f"""
            WITH f AS (
              SELECT event_id, event_type AS Origin, CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS DepTime,
                     user_id, value, CAST(ts AS DATE) AS FlightDate
              FROM events),
            z AS ({_EVENT_ZONES_SQL}),
            u AS (
              SELECT f.*,
                     {_utc_instant_sql(_LOCAL_CLOCK_SQL, "z.iana_tz")} AS FlightTime
              FROM f LEFT JOIN z ON f.Origin = z.iata_code)
            SELECT event_id, Origin, DepTime, user_id, value, FlightTime,
                   CASE WHEN keep THEN nft END AS FlightTime_next,
                   CASE WHEN keep THEN nu END AS user_next,
                   CASE WHEN keep THEN (epoch_us(nft) - epoch_us(FlightTime)) // 1000000 END AS diff_next,
                   FlightDate
            FROM (
              SELECT *, (nd IS NULL OR nd <= FlightDate + 1) AS keep
              FROM (
                SELECT *,
                       LEAD(FlightTime) OVER w AS nft, LEAD(user_id) OVER w AS nu, LEAD(FlightDate) OVER w AS nd
                FROM u
                WINDOW w AS (PARTITION BY Origin ORDER BY FlightTime ASC NULLS LAST, event_id ASC)
              )
            )
        """,
    }
