"""Declarative typed projection: keep, cast and comment configured columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnSpec:
    """One output column.

    ``type`` is any Spark DDL type name (``int``, ``decimal(10,2)``, ...);
    ``date`` is parsed with ``format`` when given, else with the default parser.
    ``comment`` is stored as column metadata and becomes the table comment.
    """

    name: str
    type: str
    format: str | None = None
    comment: str = ""

    @classmethod
    def from_dict(cls, d: Mapping) -> "ColumnSpec":
        return cls(name=d["name"], type=d["type"], format=d.get("format"), comment=d.get("comment", ""))


def name_key(spark: SparkSession) -> Callable[[str], str]:
    """How the session compares column names (``spark.sql.caseSensitive``)."""
    exact = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return str if exact else str.lower


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def typed_column(spec: ColumnSpec, *, on_error: str = "raise") -> Column:
    """The column for one spec. ``on_error="null"`` turns bad values into null instead of failing."""
    src = F.col(_quote(spec.name))
    lenient = on_error == "null"
    if spec.type.strip().lower() == "date":
        if spec.format:
            value = F.try_to_date(src, spec.format) if lenient else F.to_date(src, spec.format)
        else:
            value = F.try_to_date(src) if lenient else F.to_date(src)
    else:
        value = src.try_cast(spec.type) if lenient else src.cast(spec.type)
    return value.alias(spec.name, metadata={"comment": spec.comment})


def project_typed(df: DataFrame, specs: Iterable[ColumnSpec | Mapping], *, on_error: str = "raise") -> DataFrame:
    """Select only the configured columns, in spec order, cast and commented.

    ``on_error``: ``"raise"`` (ANSI casts fail on bad input) or ``"null"``.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")
    specs = [s if isinstance(s, ColumnSpec) else ColumnSpec.from_dict(s) for s in specs]
    # Names follow the session's rule, as in a select: without regard to case unless it says otherwise.
    fold = name_key(df.sparkSession)
    known = {fold(c) for c in df.columns}
    missing = [s.name for s in specs if fold(s.name) not in known]
    if missing:
        raise ValueError(f"configured columns not found in the data: {missing}")
    return df.select(*[typed_column(s, on_error=on_error) for s in specs])
