"""The flight load: config file, one JSON batch, UTC times, daily load."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybridge.operators.project import ColumnSpec
from daybridge.operators.utc import add_utc_time
from daybridge.plans.daily import BridgeSpec, load_day
from daybridge.sources.json_source import Rescue, ingest_json
from daybridge.sources.schemas import known_schema
from daybridge.sources.tables import FileLayout
from daybridge.sources.zones import read_zones


log = logging.getLogger("daybridge.flight_load")

# Names that existing flight data and config files use and that the
# output table keeps - columns FlightDate, DepTime, Origin, Reporting_Airline;
# zone file columns iata_code, iana_tz; added columns FlightTime, FlightTime_next,
# Airline_next, diff_next; config keys data_columns (name, type, format, comment),
# output_table, output_partitions, output_path.


@dataclass(frozen=True)
class UtcSpec:
    """Columns used to compute the UTC departure time."""

    date_col: str = "FlightDate"
    hhmm_col: str = "DepTime"
    key_col: str = "Origin"
    zone_key: str = "iata_code"
    zone_col: str = "iana_tz"
    out_col: str = "FlightTime"
    as_ntz: bool = False
    on_duplicate: str = "raise"


@dataclass(frozen=True)
class ReadSpec:
    """How the JSON is read: see ``ingest_json``, ``Rescue`` and ``known_schema``.

    ``schema_file`` keeps the schema between loads; ``quarantine``, ``max_bad_rows`` and ``max_bad_share`` say what becomes of lines that
    cannot be read (if none of them is set, such lines are rows of nulls).
    """

    schema: str | None = None
    schema_file: str | None = None
    quarantine: str | None = None
    max_bad_rows: int | None = None
    max_bad_share: float | None = None
    multi_line: bool = False
    sampling_ratio: float | None = None
    outer: bool = False
    on_map: str = "drop"
    on_error: str = "raise"

    def rescue(self) -> Rescue | None:
        limits = (self.quarantine, self.max_bad_rows, self.max_bad_share)
        return None if limits == (None, None, None) else Rescue(*limits)


def _from_fields(cls, given: Mapping | None, where: str):
    known = {f.name for f in fields(cls)}
    unknown = sorted(set(given or {}) - known)
    if unknown:
        raise ValueError(f"config: {where} has unknown fields {unknown}; known are {sorted(known)}")
    return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in (given or {}).items()})


@dataclass(frozen=True)
class IngestConfig:
    """Column specs and target table, as in the JSON config file::

        {"data_columns": [{"name": .., "type": .., "format": .., "comment": ..}, ..],
         "output_table": "default.flights", "output_partitions": 10, "output_path": "..",
         "utc": {"key_col": "Origin", ..},                    fields of UtcSpec
         "bridge": {"keys": ["Origin"], "tie_breakers": [..], ..},   fields of BridgeSpec
         "read": {"schema": "DDL", "multi_line": false, "sampling_ratio": 0.1,
                  "outer": false, "on_map": "drop", "on_error": "raise",
                  "schema_file": "..", "quarantine": "..", "max_bad_rows": 100, "max_bad_share": 0.01},
         "files": {"file_bytes": 268435456}}                  fields of FileLayout

    The last four are optional. A field they do not know is an error; other
    top-level keys (deployment settings) are ignored.
    """

    specs: tuple[ColumnSpec, ...]
    output_table: str
    output_partitions: int | None = None
    table_location: str | None = None
    utc: UtcSpec = field(default_factory=UtcSpec)
    bridge: BridgeSpec = field(default_factory=BridgeSpec)
    read: ReadSpec = field(default_factory=ReadSpec)
    files: FileLayout | None = None

    @classmethod
    def from_dict(cls, d: Mapping) -> "IngestConfig":
        return cls(
            specs=tuple(ColumnSpec.from_dict(c) for c in d["data_columns"]),
            output_table=d["output_table"],
            output_partitions=d.get("output_partitions"),
            table_location=d.get("output_path"),
            utc=_from_fields(UtcSpec, d.get("utc"), "utc"),
            bridge=_from_fields(BridgeSpec, d.get("bridge"), "bridge"),
            read=_from_fields(ReadSpec, d.get("read"), "read"),
            files=_from_fields(FileLayout, d["files"], "files") if d.get("files") else None,
        )

    @classmethod
    def from_file(cls, path: str | Path) -> "IngestConfig":
        with Path(path).open("r", encoding="utf-8") as f:
            return cls.from_dict(json.load(f))


def prepare_batch(
    spark: SparkSession,
    data_path: str | list[str],
    config: IngestConfig,
    zones: DataFrame,
    *,
    schema: T.StructType | str | None = None,
    rescue: Rescue | None = None,
) -> DataFrame:
    """Ingest one JSON batch and add the UTC departure time."""
    r = config.read
    schema = schema or r.schema
    if schema is None and r.schema_file:
        known = known_schema(spark, data_path, r.schema_file, multi_line=r.multi_line)
        if known.new_fields:
            log.warning("%s: fields that the kept schema lacks: %s", data_path, known.new_fields)
        schema = known.schema
    flights = ingest_json(
        spark,
        data_path,
        config.specs,
        schema=schema,
        multi_line=r.multi_line,
        sampling_ratio=r.sampling_ratio,
        outer=r.outer,
        on_map=r.on_map,
        on_error=r.on_error,
        rescue=rescue,
    )
    return with_utc(flights, config, zones)


def with_utc(flights: DataFrame, config: IngestConfig, zones: DataFrame) -> DataFrame:
    """Add the UTC departure time as the config says."""
    u = config.utc
    return add_utc_time(
        flights,
        zones,
        date_col=u.date_col,
        hhmm_col=u.hhmm_col,
        key_col=u.key_col,
        zone_key=u.zone_key,
        zone_col=u.zone_col,
        out_col=u.out_col,
        as_ntz=u.as_ntz,
        on_duplicate=u.on_duplicate,
    )


def process_file(
    spark: SparkSession,
    data_path: str | list[str],
    config: IngestConfig,
    zones: DataFrame | str,
    *,
    schema: T.StructType | str | None = None,
    lookahead_days: int = 0,
    merge: bool = False,
    rescue: Rescue | None = None,
) -> list:
    """Ingest a file, add UTC and next-departure columns, load it into the table.

    ``zones`` is the zone dimension or the path of its CSV file; ``merge`` adds
    the file's rows to days that the table has. Lines that cannot be read are counted and kept apart as ``rescue``, or the
    config, says, before anything is written: too many end the load with ``BadRecords``. Returns the days written.
    """
    rescue = rescue or config.read.rescue()
    if isinstance(zones, str):
        zones = read_zones(spark, zones, key_col=config.utc.zone_key, zone_col=config.utc.zone_col)
    batch = prepare_batch(spark, data_path, config, zones, schema=schema, rescue=rescue)

    def settle() -> None:
        if rescue is not None and rescue.settle():
            log.warning("%s: %d of %d lines cannot be read", data_path, rescue.bad, rescue.total)

    return load_day(
        batch,
        config.output_table,
        config.bridge,
        location=config.table_location,
        lookahead_days=lookahead_days,
        output_partitions=config.output_partitions,
        files=config.files,
        merge=merge,
        before_commit=settle,
    )
