import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daybridge import BridgeSpec, bulk_bridge, bulk_load, column_comments, load_day, project_typed, ColumnSpec

SPEC = BridgeSpec(keys=("Origin",), time_col="FlightTime", carry={"Airline_next": "Airline"}, tie_breakers=("id",))


def _day(spark, d, rows):
    """rows: (id, origin, HH:MM or None, airline) on day d."""
    data = [
        (i, o, d, None if hm is None else datetime.fromisoformat(f"{d.isoformat()} {hm}"), a) for i, o, hm, a in rows
    ]
    df = spark.createDataFrame(data, "id long, Origin string, FlightDate date, FlightTime timestamp, Airline string")
    specs = [
        ColumnSpec("id", "bigint", comment="flight id"),
        ColumnSpec("Origin", "string", comment="origin airport"),
        ColumnSpec("FlightDate", "date", comment="flight date"),
        ColumnSpec("FlightTime", "timestamp", comment="departure, UTC"),
        ColumnSpec("Airline", "string", comment="airline"),
    ]
    return project_typed(df, specs)


D1, D2, D3 = date(2023, 1, 1), date(2023, 1, 2), date(2023, 1, 3)


def _days(spark):
    return {
        D1: _day(spark, D1, [(1, "A", "10:00", "a1"), (2, "A", "23:00", "a2"), (3, "B", "12:00", "b1")]),
        D2: _day(spark, D2, [(4, "A", "01:00", "a3"), (5, "A", "05:00", "a4")]),  # B idle on D2
        D3: _day(spark, D3, [(6, "A", "02:00", "a5"), (7, "B", "03:00", "b2")]),
    }


def _table():
    return f"flights_{uuid.uuid4().hex[:8]}"


def _state(spark, table):
    return {r.id: (r.Airline_next, r.diff_next) for r in spark.read.table(table).collect()}


LOOP_RESULT = {
    1: ("a2", 13 * 3600),
    2: ("a3", 2 * 3600),  # bridged over midnight
    3: (None, None),  # B is idle on D2: its D3 flight is beyond the horizon
    4: ("a4", 4 * 3600),
    5: ("a5", 21 * 3600),
    6: (None, None),
    7: (None, None),
}


def test_three_days_keep_day_one_and_bridge(spark):
    days, table = _days(spark), _table()
    assert load_day(days[D1], table, SPEC) == [D1]
    assert _state(spark, table)[2] == (None, None)
    assert load_day(days[D2], table, SPEC) == [D1, D2]
    assert load_day(days[D3], table, SPEC) == [D2, D3]
    assert _state(spark, table) == LOOP_RESULT
    cols = spark.read.table(table).columns
    assert cols[-1] == "FlightDate" and cols[-4:-1] == ["FlightTime_next", "Airline_next", "diff_next"]
    assert column_comments(spark, table)["Origin"] == "origin airport"


def test_replay_newest_day_is_idempotent_and_older_reload_resets_tails(spark):
    days, table = _days(spark), _table()
    for d in (D1, D2, D3):
        load_day(days[d], table, SPEC)
    load_day(days[D3], table, SPEC)
    assert _state(spark, table) == LOOP_RESULT
    assert spark.read.table(table).count() == 7
    load_day(days[D2], table, SPEC)  # D3 is not consulted
    assert _state(spark, table)[5] == (None, None)
    load_day(days[D2], table, SPEC, lookahead_days=1)
    assert _state(spark, table) == LOOP_RESULT


def test_empty_batch_is_noop_and_null_date_refused(spark):
    days, table = _days(spark), _table()
    assert load_day(days[D1].limit(0), table, SPEC) == []
    assert not spark.catalog.tableExists(table)
    bad = days[D1].withColumn("FlightDate", F.lit(None).cast("date"))
    with pytest.raises(ValueError, match="null"):
        load_day(bad, table, SPEC)


def test_multi_day_batch_equals_daily_loads(spark):
    days, table = _days(spark), _table()
    load_day(days[D1].unionByName(days[D2]).unionByName(days[D3]), table, SPEC)
    assert _state(spark, table) == LOOP_RESULT


def test_changed_columns_are_refused(spark):
    days, table = _days(spark), _table()
    load_day(days[D1], table, SPEC)
    with pytest.raises(ValueError, match="extra_col"):
        load_day(days[D2].withColumn("extra_col", F.lit(1)), table, SPEC)
    with pytest.raises(ValueError, match="Airline"):
        load_day(days[D2].drop("Airline"), table, BridgeSpec(keys=("Origin",), time_col="FlightTime", carry={}))


def test_bulk_bridge_and_bulk_load_equal_the_loop(spark, tmp_dir):
    days = _days(spark)
    history = days[D1].unionByName(days[D2]).unionByName(days[D3])
    got = {r.id: (r.Airline_next, r.diff_next) for r in bulk_bridge(history, SPEC).collect()}
    assert got == LOOP_RESULT
    split = BridgeSpec(**{**SPEC.__dict__, "strategy": "split", "segment_rows": 1})
    assert {r.id: (r.Airline_next, r.diff_next) for r in bulk_bridge(history, split).collect()} == LOOP_RESULT
    table = _table()
    bulk_load(history, table, SPEC, location=f"{tmp_dir}/{table}")
    assert _state(spark, table) == LOOP_RESULT


def test_null_times_in_daily_load_chain_like_the_reference(spark):
    table = _table()
    d1 = _day(spark, D1, [(1, "A", "10:00", "t1"), (2, "A", None, "n1")])
    d2 = _day(spark, D2, [(3, "A", "09:00", "t2"), (4, "A", None, "n2")])
    load_day(d1, table, SPEC)
    load_day(d2, table, SPEC)
    st = _state(spark, table)
    # D1's timed row now reaches D2's timed row; null-time rows chain last, by id.
    assert st[1] == ("t2", 23 * 3600)
    assert st[3] == ("n1", None)
    assert st[2] == ("n2", None)
    bulk = {r.id: (r.Airline_next, r.diff_next) for r in bulk_bridge(d1.unionByName(d2), SPEC).collect()}
    assert bulk == st


def test_lookback_two_days(spark):
    days, table = _days(spark), _table()
    spec2 = BridgeSpec(**{**SPEC.__dict__, "lookback_days": 2})
    for d in (D1, D2, D3):
        load_day(days[d], table, spec2)
    assert _state(spark, table)[3] == ("b2", 39 * 3600)
    got = {r.id: (r.Airline_next, r.diff_next) for r in bulk_bridge(
        days[D1].unionByName(days[D2]).unionByName(days[D3]), spec2).collect()}
    assert got == _state(spark, table)


def test_bulk_load_after_daily_loads_bridges_the_boundary(spark, tmp_dir):
    days, table = _days(spark), _table()
    load_day(days[D1], table, SPEC, location=f"{tmp_dir}/{table}")
    bulk_load(days[D2].unionByName(days[D3]), table, SPEC)
    assert _state(spark, table) == LOOP_RESULT


def test_daily_loads_on_the_split_path(spark):
    days, table = _days(spark), _table()
    split = BridgeSpec(**{**SPEC.__dict__, "strategy": "split", "segment_rows": 1})
    for d in (D1, D2, D3):
        load_day(days[d], table, split)
    assert _state(spark, table) == LOOP_RESULT


def test_multi_day_batch_with_null_times_equals_daily_loads(spark):
    days = [
        _day(spark, D1, [(1, "A", "10:00", "t1"), (2, "A", None, "n1"), (3, "B", None, "n2")]),
        _day(spark, D2, [(4, "A", "09:00", "t2"), (5, "A", None, "n3")]),
        _day(spark, D3, [(6, "A", None, "n4"), (7, "B", "08:00", "t3"), (8, "A", "07:00", "t4")]),
    ]
    loop, batch = _table(), _table()
    for d in days:
        load_day(d, loop, SPEC)
    load_day(days[0].unionByName(days[1]).unionByName(days[2]), batch, SPEC)
    assert _state(spark, batch) == _state(spark, loop)
    # the first null-time row of day 1 is chained within days 1-2 only, not to day 3's
    assert _state(spark, loop)[2] == ("n3", None)


def test_multi_day_batch_equals_daily_loads_for_any_times(spark):
    # a key over two far zones: a later day holds earlier times
    at = lambda d, h: datetime.fromisoformat(f"{d.isoformat()} 00:00") + timedelta(hours=h)
    rows = [(1, "A", D1, at(D1, 30), "x"), (2, "A", D2, at(D1, 20), "y"), (3, "A", D3, at(D1, 25), "z"), (4, "A", D3, None, "n")]
    rows += [(5, "B", D1, at(D1, 9), "p"), (6, "B", D2, at(D1, 9), "q"), (7, None, D1, at(D1, 1), "r"), (8, None, D2, at(D2, 1), "s")]
    df = spark.createDataFrame(rows, "id long, Origin string, FlightDate date, FlightTime timestamp, Airline string")
    for spec in (SPEC, BridgeSpec(**{**SPEC.__dict__, "tie_breakers": ()})):
        loop, batch, bulk = _table(), _table(), _table()
        for d in (D1, D2, D3):
            load_day(df.where(F.col("FlightDate") == F.lit(d)), loop, spec)
        load_day(df, batch, spec)
        bulk_load(df, bulk, spec)
        assert _state(spark, batch) == _state(spark, loop) == _state(spark, bulk)


def test_layouts_of_a_day_give_one_table(spark):
    rows = [(i, "A", D1, datetime(2023, 1, 1, i % 3), f"a{i % 5}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, Origin string, FlightDate date, FlightTime timestamp, Airline string")
    spec = BridgeSpec(**{**SPEC.__dict__, "tie_breakers": (), "carry": {"next_id": "id"}})
    states = []
    for parts in (1, 3, 8):
        table = _table()
        load_day(df.repartition(parts).orderBy(F.rand(parts)), table, spec)
        states.append({r.id: r.next_id for r in spark.read.table(table).collect()})
    assert states[0] == states[1] == states[2]


def test_halves_of_a_day_are_merged(spark):
    days, table = _days(spark), _table()
    load_day(days[D1].where("id <> 2"), table, SPEC)
    load_day(days[D2], table, SPEC)
    load_day(days[D1].where("id = 2"), table, SPEC, merge=True, lookahead_days=1)
    load_day(days[D3], table, SPEC)
    assert _state(spark, table) == LOOP_RESULT


def test_bulk_load_into_the_middle_joins_both_sides(spark):
    days, table = _days(spark), _table()
    load_day(days[D1].unionByName(days[D3]), table, SPEC)
    bulk_load(days[D2], table, SPEC)
    assert _state(spark, table) == LOOP_RESULT


def test_what_would_be_lost_is_refused(spark, tmp_dir):
    from daybridge.sources.tables import overwrite_partitions

    days, table = _days(spark), _table()
    load_day(days[D1], table, SPEC)
    more = BridgeSpec(**{**SPEC.__dict__, "carry": {"Airline_next": "Airline", "id_next": "id"}})
    with pytest.raises(ValueError, match="id_next"):
        load_day(days[D2], table, more)
    other = BridgeSpec(**{**SPEC.__dict__, "carry": {"Airline_next": "id"}})
    with pytest.raises(ValueError, match="Airline_next"):
        load_day(days[D2], table, other)
    with pytest.raises(ValueError, match="surplus"):
        overwrite_partitions(spark.read.table(table).withColumn("surplus", F.lit(1)), table)
    plain = _table()
    bulk_bridge(days[D1], SPEC).write.saveAsTable(plain)
    for load in (load_day, bulk_load):
        with pytest.raises(ValueError, match="partitioned"):
            load(days[D1], plain, BridgeSpec(**{**SPEC.__dict__, "lookback_days": 0}))
    assert spark.read.table(plain).count() == 3
    bad = days[D1].withColumn("FlightDate", F.lit(None).cast("date"))
    for refused in (lambda: bulk_bridge(bad, SPEC), lambda: bulk_load(bad, _table(), SPEC)):
        with pytest.raises(ValueError, match="null"):
            refused()


def test_a_day_is_written_as_few_files(spark, tmp_dir):
    import glob

    rows = [(i, "A", D1 + timedelta(days=i % 6), datetime(2023, 1, 1) + timedelta(days=i % 6, minutes=i), "a") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, Origin string, FlightDate date, FlightTime timestamp, Airline string")
    table = _table()
    bulk_load(df.repartition(12), table, SPEC, location=f"{tmp_dir}/{table}")
    files = glob.glob(f"{tmp_dir}/{table}/*/part-*")
    assert len(files) == 6
    load_day(df.where("id % 6 = 5"), table, SPEC, output_partitions=1)
    assert len(glob.glob(f"{tmp_dir}/{table}/FlightDate=2023-01-06/part-*")) == 1
