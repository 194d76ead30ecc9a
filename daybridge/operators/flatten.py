"""Recursive flattening of nested structs and arrays.

Each pass looks at the top-level fields only:

* a struct is replaced, in place, by its children (no name prefix);
* an array is exploded under its own name (inner explode: a null or empty array
  drops the row, unless ``outer=True``); sibling arrays multiply;
* a map is dropped (``on_map="drop"``, the default) or kept as it is (``"keep"``);
  so is a user-defined type (for example an ML vector), which is stored like one;
* anything else passes through.

Passes repeat until no struct or array is left. Only the schema is inspected on
the driver; the work is a chain of Project/Generate nodes, no shuffle.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.operators.project import name_key


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _map_like(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.MapType, T.UserDefinedType))


def flatten(df: DataFrame, *, outer: bool = False, on_map: str = "drop") -> DataFrame:
    """Flatten ``df`` until every column is a scalar (or a kept map).

    Raises ``ValueError`` when two columns would end up with the same name (by
    the session's rule on case), since later selects by name could not tell them apart.
    """
    if on_map not in ("drop", "keep"):
        raise ValueError(f"on_map must be 'drop' or 'keep', not {on_map!r}")
    explode = F.explode_outer if outer else F.explode
    fold = name_key(df.sparkSession)
    while True:
        fields = df.schema.fields
        arrays = [f for f in fields if isinstance(f.dataType, T.ArrayType)]
        has_struct = any(isinstance(f.dataType, T.StructType) for f in fields)
        has_dropped_map = on_map == "drop" and any(_map_like(f.dataType) for f in fields)
        if not arrays and not has_struct and not has_dropped_map:
            return df
        # At most one generator per select; the other arrays wait for the next pass.
        exploded = arrays[0].name if arrays else None
        cols: list[Column] = []
        names: list[str] = []
        for f in fields:
            ref = F.col(_quote(f.name))
            if isinstance(f.dataType, T.StructType):
                for child in f.dataType.fields:
                    cols.append(ref.getField(child.name).alias(child.name))
                    names.append(child.name)
            elif f.name == exploded:
                cols.append(explode(ref).alias(f.name))
                names.append(f.name)
            elif _map_like(f.dataType) and on_map == "drop":
                continue
            else:
                cols.append(ref)
                names.append(f.name)
        counted = Counter(map(fold, names))
        dupes = sorted({n for n in names if counted[fold(n)] > 1})
        if dupes:
            raise ValueError(f"flattening gives duplicate column names: {dupes}")
        df = df.select(*cols)
