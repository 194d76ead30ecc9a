from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from daybridge import add_utc_time

ZONES = [
    ("JFK", "America/New_York"),
    ("PHX", "America/Phoenix"),
    ("MAD", "Europe/Madrid"),
    ("NOZ", None),
]


@pytest.fixture()
def zones(spark):
    return spark.createDataFrame(ZONES, "iata_code string, iana_tz string")


def _utc(spark, zones, rows, as_ntz=True, date_type="string"):
    df = spark.createDataFrame(rows, f"Origin string, FlightDate {date_type}, DepTime bigint")
    out = add_utc_time(df, zones, as_ntz=as_ntz)
    return [r.FlightTime for r in out.orderBy("Origin", "FlightDate", "DepTime").collect()]


def test_instant_is_the_default(spark, zones):
    df = spark.createDataFrame([("MAD", "2024-02-29", 45)], ["Origin", "FlightDate", "DepTime"])
    out = add_utc_time(df, zones)
    assert out.columns == ["Origin", "FlightDate", "DepTime", "FlightTime"]
    assert dict(out.dtypes)["FlightTime"] == "timestamp"
    assert out.first().FlightTime == datetime(2024, 2, 28, 23, 45)


@pytest.mark.parametrize(
    "hhmm, expected",
    [
        (None, None),
        (0, datetime(2023, 12, 25, 5, 0)),
        (7, datetime(2023, 12, 25, 5, 7)),
        (1260, None),
        (2400, None),
        (12345, datetime(2023, 12, 25, 17, 34)),
        (-5, None),
    ],
)
def test_clock_edges(spark, zones, hhmm, expected):
    assert _utc(spark, zones, [("JFK", "2023-12-25", hhmm)]) == [expected]


def test_unknown_airport_and_null_zone(spark, zones):
    assert _utc(spark, zones, [("XXX", "2023-12-25", 1000), ("NOZ", "2023-12-25", 1000)]) == [None, None]


def test_dst_gap_overlap_and_phoenix_do_not_depend_on_session_zone(spark, zones):
    rows = [
        ("JFK", "2023-03-12", 230),
        ("JFK", "2023-11-05", 130),
        ("PHX", "2023-03-12", 230),
    ]
    expected = [datetime(2023, 3, 12, 7, 30), datetime(2023, 11, 5, 5, 30), datetime(2023, 3, 12, 9, 30)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert _utc(spark, zones, rows, as_ntz=True) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    # the instant form agrees (rendered in the UTC session)
    assert _utc(spark, zones, rows, as_ntz=False) == expected


def test_date_typed_input_and_broadcast_choice(spark, zones):
    from datetime import date

    df = spark.createDataFrame([("MAD", date(2023, 7, 1), 1200)], "Origin string, FlightDate date, DepTime int")
    for b in (None, True, False):
        assert add_utc_time(df, zones, as_ntz=True, broadcast=b).first().FlightTime == datetime(2023, 7, 1, 10, 0)


def test_invalid_zone_name_fails(spark):
    bad = spark.createDataFrame([("BAD", "Mars/Olympus")], "iata_code string, iana_tz string")
    df = spark.createDataFrame([("BAD", "2023-12-25", 1000)], ["Origin", "FlightDate", "DepTime"])
    for as_ntz in (True, False):
        with pytest.raises(PySparkException):
            add_utc_time(df, bad, as_ntz=as_ntz).collect()
