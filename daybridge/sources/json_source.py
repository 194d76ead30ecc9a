"""JSON batches: scan, flatten and project in one call."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.operators.flatten import flatten
from daybridge.operators.project import ColumnSpec, name_key, project_typed


BAD_LINE = "_db_bad_line"


class BadRecords(ValueError):
    """A batch has more lines that are no JSON of its schema than its reader allows."""


class Rescue:
    """Keeps lines that cannot be read apart from the rows of a batch.

    Hand it to :func:`ingest_json`: rows are then those of good lines alone, and the lines are counted by the pass
    that reads them. After an action on the rows, :meth:`settle` compares the counts with the limits
    (``max_rows`` bad lines, or ``max_share`` of all; None: any number), raises :class:`BadRecords` beyond, and otherwise
    writes the bad lines with their file to the ``quarantine`` folder. That takes a second read of the input,
    which runs only if there is a bad line and a folder for it.
    """

    def __init__(self, quarantine: str | None = None, max_rows: int | None = None, max_share: float | None = None):
        self.quarantine, self.max_rows, self.max_share = quarantine, max_rows, max_share
        self.seen = Observation("json-lines")
        self.lines: DataFrame | None = None
        self.bad: int | None = None
        self.total: int | None = None

    def apart(self, raw: DataFrame) -> DataFrame:
        """Good rows of a scan that has the column ``BAD_LINE``."""
        self.lines = raw
        is_bad = F.col(BAD_LINE).isNotNull()
        counted = raw.observe(self.seen, F.count(F.lit(1)).alias("total"), F.count_if(is_bad).alias("bad"))
        return counted.where(~is_bad).drop(BAD_LINE)

    def settle(self) -> int:
        """The number of bad lines, once the rows have been read whole and if there are not too many."""
        if self.lines is None:
            raise ValueError("nothing has been read yet")
        got = self.seen.get
        self.total, self.bad = got["total"], got["bad"]
        over = self.max_rows is not None and self.bad > self.max_rows
        if over or (self.max_share is not None and self.bad > self.max_share * self.total):
            raise BadRecords(f"{self.bad} of {self.total} JSON lines cannot be read")
        if self.bad and self.quarantine:
            # All columns are parsed again: which lines are bad depends on them (and Spark refuses to read the line alone).
            parsed = F.to_json(F.struct(*[F.col(f"`{c}`") for c in self.lines.columns if c != BAD_LINE])).isNotNull()
            bad = self.lines.where(F.col(BAD_LINE).isNotNull() & parsed)
            bad.select(F.col(BAD_LINE).alias("line"), F.input_file_name().alias("file")).write.mode("append").parquet(self.quarantine)
        return self.bad


class _Names:
    """A set of column names under a rule of comparison."""

    def __init__(self, names: Iterable[str], fold: Callable[[str], str]):
        self.fold, self.names = fold, {fold(n) for n in names}

    def __contains__(self, name: str) -> bool:
        return self.fold(name) in self.names


def _prune_type(name: str, data_type: T.DataType, needed: _Names, on_map: str) -> T.DataType | None:
    """The part of one field that flattening + projecting ``needed`` columns can see.

    Scalars survive when their (flattened) name is needed; structs keep the
    children that survive; arrays always survive because their length decides
    how many rows the explode produces (an element struct keeps at least one
    child for that); maps are dropped when flattening drops them.
    """
    if isinstance(data_type, T.StructType):
        kept = []
        for f in data_type.fields:
            child = _prune_type(f.name, f.dataType, needed, on_map)
            if child is not None:
                kept.append(T.StructField(f.name, child, f.nullable, f.metadata))
        return T.StructType(kept) if kept else None
    if isinstance(data_type, T.ArrayType):
        element = data_type.elementType
        if isinstance(element, T.StructType):
            pruned = _prune_type(name, element, needed, on_map)
            if pruned is None:
                # nothing inside is needed, but the length still counts: keep one plain field
                plain = [f for f in element.fields if not isinstance(f.dataType, (T.StructType, T.MapType))]
                pruned = T.StructType((plain or list(element.fields))[:1])
            return T.ArrayType(pruned, data_type.containsNull)
        if isinstance(element, T.ArrayType):
            return T.ArrayType(_prune_type(name, element, needed, on_map), data_type.containsNull)
        return data_type
    if isinstance(data_type, (T.MapType, T.UserDefinedType)):
        return data_type if on_map == "keep" and name in needed else None
    return data_type if name in needed else None


def prune_schema(
    schema: T.StructType, columns: Iterable[str], *, on_map: str = "drop", fold: Callable[[str], str] = str.lower
) -> T.StructType:
    """Narrow a JSON read schema to what ``flatten`` + selecting ``columns`` uses.

    Reading with the narrowed schema gives the same rows and values, but the
    JSON parser skips every other field (Spark does not prune nested JSON
    fields by itself). ``fold`` says which names are the same; the default, like
    Spark's, does not regard case.
    """
    needed = _Names(columns, fold)
    kept = []
    for f in schema.fields:
        child = _prune_type(f.name, f.dataType, needed, on_map)
        if child is not None:
            kept.append(T.StructField(f.name, child, f.nullable, f.metadata))
    return T.StructType(kept)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    sampling_ratio: float | None = None,
    bad_lines: bool = False,
) -> DataFrame:
    """Scan JSON lines (or one document per file with ``multi_line``).

    Without ``schema`` Spark infers it, which reads the input once more; pass a
    schema (possibly narrower than the data) for large inputs, since nested
    fields of JSON are not pruned by the optimizer. Malformed lines are kept
    (PERMISSIVE mode) as rows of nulls; with ``bad_lines`` such a row has the
    line's text in the column ``BAD_LINE``, which is null in all others.
    """
    reader = spark.read
    if bad_lines:
        if schema is None:
            # the parser's own column for such lines is no field of the data
            own = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
            found = read_json(spark, path, multi_line=multi_line, sampling_ratio=sampling_ratio).schema
            schema = T.StructType([f for f in found.fields if f.name != own])
        elif isinstance(schema, str):
            schema = spark.createDataFrame([], schema).schema
        schema = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD_LINE)
    if schema is not None:
        reader = reader.schema(schema)
    if multi_line:
        reader = reader.option("multiLine", "true")
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    return reader.json(path)


def ingest_json(
    spark: SparkSession,
    path: str | list[str],
    specs: Iterable[ColumnSpec | Mapping],
    *,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    sampling_ratio: float | None = None,
    outer: bool = False,
    on_map: str = "drop",
    on_error: str = "raise",
    prune: bool = True,
    rescue: Rescue | None = None,
) -> DataFrame:
    """Read a JSON batch, flatten it and keep the configured, typed columns.

    With ``prune`` (default) the schema (given, or inferred by Spark) is
    narrowed to the fields the specs need before the data is read, see
    :func:`prune_schema`. A ``rescue`` keeps malformed lines apart; without it
    they are rows of nulls.
    """
    specs = [s if isinstance(s, ColumnSpec) else ColumnSpec.from_dict(s) for s in specs]
    if prune:
        if schema is None:
            schema = read_json(spark, path, multi_line=multi_line, sampling_ratio=sampling_ratio).schema
        elif isinstance(schema, str):
            schema = spark.createDataFrame([], schema).schema
        schema = prune_schema(schema, [s.name for s in specs], on_map=on_map, fold=name_key(spark))
    raw = read_json(
        spark, path, schema=schema, multi_line=multi_line, sampling_ratio=sampling_ratio, bad_lines=rescue is not None
    )
    if rescue is not None:
        raw = rescue.apart(raw)
    return project_typed(flatten(raw, outer=outer, on_map=on_map), specs, on_error=on_error)
