"""Column expressions for wall-clock times, zones and gaps.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen and never depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hhmm_text(hhmm: Column) -> Column:
    """Clock text ``HHmm`` from an integer like 1535 or 7.

    The value is read as an int first (so 7.0 becomes "0007", not "07.0"), then
    left-padded with zeros to four characters; ``lpad`` also cuts longer text,
    so 12345 gives "1234". Text that is not a number gives null.
    """
    return F.lpad(hhmm.try_cast("int").cast("string"), 4, "0")


def date_text(date: Column, data_type: T.DataType) -> Column:
    """``yyyy-MM-dd`` text of a date, a timestamp's date, or a date string as given."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(date).cast("string")
    if isinstance(data_type, T.DateType):
        return date.cast("string")
    return date.cast("string")


def local_wall_clock(date_str: Column, hhmm: Column) -> Column:
    """Local ``timestamp_ntz`` from a date text and an integer ``HHmm``.

    Null when either part is null or the clock is not a valid time of day:
    2400, minutes of 60 or more, negative numbers. ``concat`` (not
    ``concat_ws``) keeps a missing clock from turning into midnight.
    """
    clock = hhmm_text(hhmm)
    text = F.concat(date_str, F.lit(" "), clock.substr(1, 2), F.lit(":"), clock.substr(3, 2))
    return text.try_cast("timestamp_ntz")


def wall_clock_to_utc_ntz(local: Column, zone: Column) -> Column:
    """UTC wall clock (``timestamp_ntz``) of a local wall clock in a per-row IANA zone.

    A clock inside a DST gap moves forward by the gap; inside an overlap the
    earlier offset wins. A null zone gives null; an unknown zone name fails.
    """
    return F.convert_timezone(zone, F.lit("UTC"), local)


def wall_clock_to_instant(local: Column, zone: Column) -> Column:
    """The instant (``timestamp``) of a local wall clock in a per-row IANA zone.

    Same gap and overlap rules as :func:`wall_clock_to_utc_ntz`; the result does
    not depend on ``spark.sql.session.timeZone``. The fields come from a valid
    ``timestamp_ntz`` (or are null), so only an unknown zone name can fail.
    """
    return F.make_timestamp(
        F.year(local),
        F.month(local),
        F.dayofmonth(local),
        F.hour(local),
        F.minute(local),
        F.second(local),
        zone,
    )


def seconds_between(later: Column, earlier: Column, data_type: T.DataType) -> Column:
    """Whole seconds from ``earlier`` to ``later``.

    For timestamps the interval is cast to ``bigint``, which drops the fraction
    of the interval itself (0.9 s to 2.1 s is 1 second, not 2).
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return (later - earlier).cast("long")
    if isinstance(data_type, T.DateType):
        return F.datediff(later, earlier).cast("long") * F.lit(86400)
    return (later - earlier).cast("long")


def ticks(time: Column, data_type: T.DataType) -> Column | None:
    """The time as a whole number in the same order, whatever the session zone; None for types without one."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(time)
    if isinstance(data_type, T.TimestampNTZType):
        seconds = F.unix_date(F.to_date(time)).cast("long") * 86400 + F.hour(time) * 3600 + F.minute(time) * 60
        return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("long")
    if isinstance(data_type, T.DateType):
        return F.unix_date(time).cast("long")
    if isinstance(data_type, T.IntegralType):
        return time.cast("long")
    return None
