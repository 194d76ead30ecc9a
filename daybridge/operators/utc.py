"""Local date + ``HHmm`` clock + per-row IANA zone -> departure time in UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybridge.functions.clock import (
    date_text,
    local_wall_clock,
    wall_clock_to_instant,
    wall_clock_to_utc_ntz,
)

# Broadcast the zone dimension only when it has at most this many bytes (an
# airport list has some 100 KB): those of its texts, and of a row around them.
# Larger dimensions use a shuffle join, where adaptive execution can still split a hot key.
MAX_BROADCAST_ZONE_BYTES = 64 << 20
ROW_BYTES = 64


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def add_utc_time(
    df: DataFrame,
    zones: DataFrame,
    *,
    date_col: str = "FlightDate",
    hhmm_col: str = "DepTime",
    key_col: str = "Origin",
    zone_key: str = "iata_code",
    zone_col: str = "iana_tz",
    out_col: str = "FlightTime",
    as_ntz: bool = False,
    broadcast: bool | None = None,
    on_duplicate: str = "raise",
) -> DataFrame:
    """Append ``out_col``, the UTC time of the local ``date_col`` + ``hhmm_col``.

    The zone comes from a left join of ``key_col`` to ``zones[zone_key]``; a key
    missing from the dimension keeps its row with a null time. A null or invalid
    clock (2400, minutes >= 60, negative) gives null; more than four digits are
    cut to four (12345 -> 12:34). The clock is read as it is written, without
    rolling past midnight. An unknown zone name fails the query.

    ``as_ntz=False`` gives a ``timestamp`` instant; ``as_ntz=True`` gives the UTC
    wall clock as ``timestamp_ntz``. Neither depends on the session time zone.

    Each key has one zone, so that no row of ``df`` is ever doubled. One aggregate over the dimension
    tells whether a key is listed twice: ``on_duplicate="raise"`` refuses it and names some, ``"first"`` takes
    the zone that comes first by name (a null zone last). Rows of the dimension without key are left out.

    ``broadcast``: ``None`` measures the dimension in the same aggregate and broadcasts it when it has at
    most ``MAX_BROADCAST_ZONE_BYTES``; ``True``/``False`` force the choice.
    Output: the input columns in order, then ``out_col``.
    """
    if out_col in df.columns:
        raise ValueError(f"column {out_col!r} already exists")
    zone_alias_key, zone_alias_tz = "_db_zone_key", "_db_zone"
    dim = zones.select(F.col(_quote(zone_key)).alias(zone_alias_key), F.col(_quote(zone_col)).alias(zone_alias_tz))
    if on_duplicate not in ("raise", "first"):
        raise ValueError(f"on_duplicate must be 'raise' or 'first', not {on_duplicate!r}")
    dim, size = _one_zone_per_key(dim, zone_alias_key, zone_alias_tz, on_duplicate)
    if broadcast is None:
        broadcast = size <= MAX_BROADCAST_ZONE_BYTES
    if broadcast:
        dim = F.broadcast(dim)
    joined = df.join(dim, F.col(_quote(key_col)) == F.col(zone_alias_key), "left")

    local = local_wall_clock(date_text(F.col(_quote(date_col)), df.schema[date_col].dataType), F.col(_quote(hhmm_col)))
    zone = F.col(zone_alias_tz)
    utc = wall_clock_to_utc_ntz(local, zone) if as_ntz else wall_clock_to_instant(local, zone)
    return joined.select(*[F.col(_quote(c)) for c in df.columns], utc.alias(out_col))


def _one_zone_per_key(dim: DataFrame, key: str, zone: str, on_duplicate: str) -> tuple[DataFrame, int]:
    """The dimension with one row per key, and its size in bytes."""
    keyed = dim.where(F.col(key).isNotNull())
    each = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(zone).alias(zone))
    text = F.octet_length(F.col(key).cast("string")) + F.coalesce(F.octet_length(zone), F.lit(0)) + ROW_BYTES
    size, doubled, some = each.agg(
        F.coalesce(F.sum(text), F.lit(0)), F.count_if(F.col("n") > 1), F.min(F.when(F.col("n") > 1, F.col(key).cast("string")))
    ).first()
    if not doubled:
        return keyed, size
    if on_duplicate == "raise":
        raise ValueError(f"the zone dimension lists {doubled} keys more than once, such as {some!r}")
    return each.select(key, zone), size
