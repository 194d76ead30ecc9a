"""Property tests: operators against brute force on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybridge import add_next_event, flatten

ROWS = st.lists(
    st.tuples(
        st.sampled_from([0, 0, 0, 1, 2, None]),  # key 0 is hot, None is a key too
        st.one_of(st.none(), st.integers(min_value=0, max_value=40)),  # time, ties and nulls
        st.integers(min_value=0, max_value=5),  # carried attribute
    ),
    min_size=1,
    max_size=60,
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _brute_force(rows):
    """id -> (next time, next attribute, gap): nulls last, ties by id."""
    by_key = {}
    for i, (k, t, a) in enumerate(rows):
        by_key.setdefault(k, []).append((t is None, t if t is not None else 0, i, t, a))
    out = {}
    for items in by_key.values():
        items.sort()
        for cur, nxt in zip(items, items[1:] + [None]):
            if nxt is None:
                out[cur[2]] = (None, None, None)
            else:
                gap = None if cur[3] is None or nxt[3] is None else nxt[3] - cur[3]
                out[cur[2]] = (nxt[3], nxt[4], gap)
    return out


@SETTINGS
@given(rows=ROWS, strategy=st.sampled_from([("window", 1), ("split", 1), ("split", 3), ("auto", 4)]))
def test_next_event_matches_brute_force(spark, rows, strategy):
    name, seg = strategy
    df = spark.createDataFrame([(k, t, a, i) for i, (k, t, a) in enumerate(rows)], "k int, t long, a int, id int")
    out = add_next_event(df, "k", "t", {"a_next": "a"}, ["id"], strategy=name, segment_rows=seg)
    got = {r.id: (r.t_next, r.a_next, r.diff_next) for r in out.collect()}
    assert got == _brute_force(rows)


NESTED = st.lists(
    st.tuples(
        st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=3)),
        st.lists(st.tuples(st.integers(0, 9), st.text("ab", max_size=2)), max_size=3),
    ),
    min_size=1,
    max_size=8,
)


@SETTINGS
@given(rows=NESTED)
def test_flatten_row_count_is_product_of_array_sizes(spark, rows):
    df = spark.createDataFrame(
        [(i, xs, [{"n": n, "s": s} for n, s in ys]) for i, (xs, ys) in enumerate(rows)],
        "id int, xs array<int>, ys array<struct<n:int, s:string>>",
    )
    inner = flatten(df)
    assert inner.columns == ["id", "xs", "n", "s"]
    assert inner.count() == sum(len(xs or []) * len(ys) for xs, ys in rows)
    outer = flatten(df, outer=True)
    assert outer.count() == sum(max(len(xs or []), 1) * max(len(ys), 1) for xs, ys in rows)


HISTORY = st.lists(
    st.tuples(
        st.integers(min_value=0, max_value=5),  # day offset: gaps and idle keys happen
        st.sampled_from(["A", "A", "B", "C"]),
        st.one_of(st.none(), st.integers(min_value=0, max_value=23)),  # hour; no time at all
        st.integers(min_value=0, max_value=2),  # minute (ties within a key and day)
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=HISTORY)
def test_bulk_bridge_equals_day_by_day_loads(spark, tmp_path_factory, rows):
    import uuid
    from datetime import date, datetime, timedelta

    from pyspark.sql import functions as F

    from daybridge import BridgeSpec, bulk_bridge, load_day

    spec = BridgeSpec(keys=("k",), time_col="t", carry={"id_next": "id"}, tie_breakers=("id",), partition_col="d")
    base = date(2024, 1, 1)
    data = [
        (i, k, base + timedelta(days=d),
         None if h is None else datetime.combine(base + timedelta(days=d), datetime.min.time()).replace(hour=h, minute=m))
        for i, (d, k, h, m) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, "id int, k string, d date, t timestamp_ntz")
    table = f"prop_{uuid.uuid4().hex[:8]}"
    location = str(tmp_path_factory.mktemp("prop") / table)
    for day in sorted({r[2] for r in data}):
        load_day(df.where(F.col("d") == F.lit(day)), table, spec, location=location)
    loop = {r.id: (r.id_next, r.diff_next) for r in spark.read.table(table).collect()}
    bulk = {r.id: (r.id_next, r.diff_next) for r in bulk_bridge(df, spec).collect()}
    assert loop == bulk


ZONES = ["America/New_York", "Europe/Madrid", "Australia/Sydney", "Asia/Kolkata", "America/Phoenix"]
# Days with DST transitions in 2023 for the zones above, plus ordinary days.
TRANSITION_DAYS = ["2023-03-12", "2023-11-05", "2023-03-26", "2023-10-29", "2023-04-02", "2023-10-01", "2023-07-15"]


def _python_utc(day, hhmm, zone):
    """UTC wall clock by zoneinfo: fold=0 moves gap times forward and takes the earlier offset in an overlap."""
    from datetime import datetime, timezone
    from zoneinfo import ZoneInfo

    text = str(int(hhmm)).rjust(4, "0")[:4] if hhmm is not None else None
    if text is None or not text.isdigit():
        return None
    hour, minute = int(text[:2]), int(text[2:])
    if hour > 23 or minute > 59:
        return None
    local = datetime.fromisoformat(f"{day} {hour:02d}:{minute:02d}").replace(tzinfo=ZoneInfo(zone), fold=0)
    return local.astimezone(timezone.utc).replace(tzinfo=None)


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(TRANSITION_DAYS),
            st.one_of(st.none(), st.integers(min_value=-5, max_value=2600), st.sampled_from([130, 230, 159, 200, 300])),
            st.sampled_from(ZONES),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_utc_matches_zoneinfo(spark, rows):
    from daybridge import add_utc_time

    zones = spark.createDataFrame([(z, z) for z in ZONES], "iata_code string, iana_tz string")
    df = spark.createDataFrame([(i, z, d, h) for i, (d, h, z) in enumerate(rows)], "id int, Origin string, FlightDate string, DepTime int")
    got = {r.id: r.FlightTime for r in add_utc_time(df, zones, as_ntz=True).collect()}
    assert got == {i: _python_utc(d, h, z) for i, (d, h, z) in enumerate(rows)}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=HISTORY)
def test_bulk_bridge_equals_daily_loads_with_two_day_lookback(spark, tmp_path_factory, rows):
    import uuid
    from datetime import date, datetime, timedelta

    from pyspark.sql import functions as F

    from daybridge import BridgeSpec, bulk_bridge, load_day

    spec = BridgeSpec(
        keys=("k",), time_col="t", carry={"id_next": "id"}, tie_breakers=("id",), partition_col="d", lookback_days=2
    )
    base = date(2024, 1, 1)
    data = [
        (i, k, base + timedelta(days=d),
         None if h is None else datetime.combine(base + timedelta(days=d), datetime.min.time()).replace(hour=h, minute=m))
        for i, (d, k, h, m) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, "id int, k string, d date, t timestamp_ntz")
    table = f"prop2_{uuid.uuid4().hex[:8]}"
    location = str(tmp_path_factory.mktemp("prop2") / table)
    for day in sorted({r[2] for r in data}):
        load_day(df.where(F.col("d") == F.lit(day)), table, spec, location=location)
    loop = {r.id: (r.id_next, r.diff_next) for r in spark.read.table(table).collect()}
    bulk = {r.id: (r.id_next, r.diff_next) for r in bulk_bridge(df, spec).collect()}
    assert loop == bulk
