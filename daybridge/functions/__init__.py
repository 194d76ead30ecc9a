"""Scalar column expressions (built-in Spark functions only)."""

from daybridge.functions.clock import (
    date_text,
    hhmm_text,
    local_wall_clock,
    seconds_between,
    wall_clock_to_instant,
    wall_clock_to_utc_ntz,
)

__all__ = [
    "date_text",
    "hhmm_text",
    "local_wall_clock",
    "seconds_between",
    "wall_clock_to_instant",
    "wall_clock_to_utc_ntz",
]
