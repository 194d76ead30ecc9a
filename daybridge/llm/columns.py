"""Column expressions shared by the native operators (no Python on the executors)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space between words, and a sign that is none, as Java pattern text.
SPACES = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often and wherever the body names it."""
    return F.transform(F.array(value), body).getItem(0)


def words_of(text: Column) -> Column:
    """Words of a text in order; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def indices(first: Column | int, last: Column) -> Column:
    """The integers from ``first`` to ``last``; none if there are none between."""
    low = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= low, F.sequence(low, last)).otherwise(F.array().cast("array<int>"))
