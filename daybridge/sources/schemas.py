"""A schema kept beside a table, so that only the first load of a folder infers one.

The schema is inferred from a sample of the files and stored as JSON text with the newest modification time that has been
looked at. A later load reads with the stored schema and starts no inference; only files that are newer are sampled, and
fields that the schema lacks are reported (and added, if wanted).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from daybridge.sources.scratch import list_files, read_text, write_text

#: Files that are read to infer a schema, or to compare new files with it.
SAMPLE_FILES = 16


@dataclass
class KnownSchema:
    """A stored schema; ``new_fields`` are those of newer files that it lacks (dotted, ``[]`` for items of lists)."""

    schema: T.StructType
    new_fields: list[str]


def field_paths(data_type: T.DataType, at: str = "") -> dict[str, T.DataType]:
    """Every scalar field of a type by its path."""
    if isinstance(data_type, T.StructType):
        out = {}
        for f in data_type.fields:
            out |= field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)
        return out
    if isinstance(data_type, T.ArrayType):
        return field_paths(data_type.elementType, f"{at}[]")
    return {at: data_type}


def merged(a: T.DataType, b: T.DataType) -> T.DataType:
    """``a`` with the fields that only ``b`` has; where both have one, the type of ``a`` stays."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        known = {f.name for f in a.fields}
        both = {f.name: f.dataType for f in b.fields}
        own = [T.StructField(f.name, merged(f.dataType, both.get(f.name, f.dataType)), f.nullable, f.metadata) for f in a.fields]
        return T.StructType([*own, *(f for f in b.fields if f.name not in known)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged(a.elementType, b.elementType), a.containsNull)
    return a


def _inferred(spark: SparkSession, files: list[tuple[str, int, int]], multi_line: bool) -> T.StructType:
    """Schema of a sample: the newest file, and others evenly over the names."""
    ordered = sorted(f[0] for f in files)
    step = max(1, len(ordered) // SAMPLE_FILES)
    sample = sorted({*ordered[::step][:SAMPLE_FILES], max(files, key=lambda f: f[1])[0]})
    reader = spark.read.option("multiLine", str(multi_line).lower())
    own = spark.conf.get("spark.sql.columnNameOfCorruptRecord")
    return T.StructType([f for f in reader.json(sample).schema.fields if f.name != own])


def known_schema(
    spark: SparkSession, paths: str | list[str], store: str, *, multi_line: bool = False, add_new: bool = False
) -> KnownSchema:
    """The schema to read ``paths`` with, kept in the file ``store``.

    The first call infers and writes it. Later calls run no job unless files have come since; these are sampled, and with
    ``add_new`` their further fields go into the stored schema. Only a bounded sample is looked at: a field that is rarer may go unseen,
    as with any read by a given schema.
    """
    files = [f for p in ([paths] if isinstance(paths, str) else paths) for f in list_files(spark, p)]
    newest = max((f[1] for f in files), default=0)
    text = read_text(spark, store)
    kept = json.loads(text) if text else None
    if kept is None:
        if not files:
            raise ValueError(f"no files to infer a schema from in {paths}")
        schema = _inferred(spark, files, multi_line)
        _keep(spark, store, schema, newest)
        return KnownSchema(schema, [])
    schema = T.StructType.fromJson(kept["schema"])
    fresh = [f for f in files if f[1] > kept["seen_until"]]
    if not fresh:
        return KnownSchema(schema, [])
    found = _inferred(spark, fresh, multi_line)
    new = sorted(set(field_paths(found)) - set(field_paths(schema)))
    schema = merged(schema, found) if add_new else schema
    _keep(spark, store, schema, max(newest, kept["seen_until"]))
    return KnownSchema(schema, new)


def _keep(spark: SparkSession, store: str, schema: T.StructType, seen_until: int) -> None:
    write_text(spark, store, json.dumps({"schema": schema.jsonValue(), "seen_until": seen_until}))
