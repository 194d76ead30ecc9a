"""Next event of the same key: its time, chosen attributes and the gap in seconds.

Order inside a key is ``time`` ascending with nulls last, then the tie-breaker
columns ascending, then a 64-bit hash of the whole row. Rows that agree in all
of these are copies of one another, so every plan and every input layout gives
the same result, with or without tie-breakers. Rows with a null time are still
chained: the last timed row of a key gets the first null-time row as successor
(its attributes, a null time and a null gap).

Two physical shapes, same result:

* ``window``: one ``lead`` over ``Window.partitionBy(keys)``. One shuffle, but a
  key's whole timeline is sorted in one task.
* ``split``: keys with more than ``segment_rows`` rows are cut into segments of
  about that many, and ``lead`` runs per (key, segment).

  Where the time counts (see ``clock.ticks``), a quantile sketch per hot key
  gives the segments' first times, which are times of rows. The rows of such a
  time go into the segment before as well, as candidates: its last row finds
  its successor there, and the candidates are dropped. One shuffle, nothing is
  written, the input is read three times: counts, sketches, rows.

  Where one instant or the null times hold more rows than a segment, or the
  time is of another type, the rows of hot keys are dealt by ranges of the full
  order (key, time, tie-breakers, row) and written once; the last row of a range
  takes the first row of the key's next range, found on a table with one row
  per hot key and range. Other keys take the plain window.

``auto`` (default) and ``split`` first count rows per key (an aggregate over the
key columns with map-side combine). Where the hot keys hold more than
``MAX_SEGMENTS * segment_rows`` rows, the segments grow instead of their number, so
that what the driver gets (samples of the ranges, first times) does not grow with the input. Without a hot key both are the plain window;
hot keys and first times are kept in a scratch folder, so that a retried task sees the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.clock import seconds_between, ticks
from daybridge.sources.scratch import materialize

DEFAULT_SEGMENT_ROWS = 2_000_000
# The keys of hot rows are broadcast when there are at most this many; there are
# at most total_rows / segment_rows of them. Beyond, the joins shuffle.
MAX_BROADCAST_HOT_KEYS = 100_000
# All hot rows together are cut into about this many segments at most: the driver gets a sample of some 300 rows
# for every range, and a task for each. A larger segment is sorted by spilling, like any large partition.
MAX_SEGMENTS = 1_000
# Ranges are placed by Spark's sample of about 100 rows each; this many more
# than rows / segment_rows keep the largest near segment_rows.
RANGE_SLACK = 1.25
# Sketched segments are half as long; an instant that fills more than two of them in a row is dealt by ranges.
# The rank error of a sketch of size k is about 2.3 / k ** 0.9; it may be half such a segment at most.
LONGEST_SKETCH = 65_535

# Steps of a search by halves in the first times of a key.
_HALVES = [1 << b for b in reversed(range(LONGEST_SKETCH.bit_length()))]

_PAIR = "_db_pair"
_NEXT = "_db_next"
_SEG = "_db_seg"
_ROW = "_db_row"
_TIME = "t"


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _col(name: str) -> Column:
    return F.col(_quote(name))


def add_next_event(
    df: DataFrame,
    keys: str | Sequence[str],
    time_col: str,
    carry: Mapping[str, str] | None = None,
    tie_breakers: Sequence[str] = (),
    *,
    next_time_col: str | None = None,
    gap_col: str | None = "diff_next",
    strategy: str = "auto",
    segment_rows: int = DEFAULT_SEGMENT_ROWS,
) -> DataFrame:
    """Append the next event of the same key to every row.

    :param keys: partition key column(s), e.g. ``"Origin"``.
    :param time_col: event time (timestamp, timestamp_ntz, date or number).
    :param carry: output name -> source column, attributes taken from the next
        row, e.g. ``{"Airline_next": "Reporting_Airline"}``.
    :param tie_breakers: columns that order rows with equal times (ascending).
    :param next_time_col: name of the next row's time, default ``<time_col>_next``.
    :param gap_col: whole seconds to the next row (``None`` to skip).
    :param strategy: ``"auto"``, ``"window"`` or ``"split"`` (see module docs).
    :param segment_rows: rows per time range of a hot key in ``split``; ranges are
        larger where more than ``MAX_SEGMENTS`` of them would be needed.

    Output: the input columns in their order, then the next time, the carried
    columns in ``carry`` order, then the gap.
    """
    keys = _as_list(keys)
    carry = dict(carry or {})
    tie_breakers = list(tie_breakers)
    next_time_col = next_time_col or f"{time_col}_next"
    if strategy not in ("auto", "window", "split"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if segment_rows < 1:
        raise ValueError("segment_rows must be positive")
    new_cols = [next_time_col, *carry, *([gap_col] if gap_col else [])]
    clash = [c for c in new_cols if c in df.columns]
    if clash:
        raise ValueError(f"output columns already exist: {clash}")

    time_type = df.schema[time_col].dataType
    base = df.withColumn(_ROW, _row_hash(df)).withColumn(_PAIR, event_pair(time_col, carry))
    order = [_col(time_col).asc_nulls_last(), *[_col(c).asc() for c in tie_breakers], F.col(_ROW).asc()]

    hot = None
    if strategy != "window":
        counts = df.groupBy(*[_col(k).alias(f"_db_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
        hot = materialize(counts.where(F.col("_n") > F.lit(segment_rows)), "hot-keys")
        hot_count, hot_rows, most = _sizes(hot)
        if hot_count and hot_rows > MAX_SEGMENTS * segment_rows:
            segment_rows = -(-hot_rows // MAX_SEGMENTS)
            hot = hot.where(F.col("_n") > F.lit(segment_rows))  # the others fit into a segment
            hot_count, hot_rows, most = _sizes(hot)
    starts = _starts(df, hot, hot_count, most, keys, time_col, segment_rows) if hot is not None and hot_count else None
    if starts is not None:
        linked = _segment_lead(base, starts, keys, ticks(_col(time_col), time_type), order)
    elif hot is None or hot_count == 0:
        window = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*order)
        linked = base.withColumn(_NEXT, F.lead(_PAIR, 1).over(window))
    else:
        segments = max(1, round(RANGE_SLACK * hot_rows / segment_rows))
        linked = _split_lead(base, hot, hot_count, segments, keys, time_col, tie_breakers, order)

    nxt = F.col(_NEXT)
    outputs = [nxt.getField(_TIME).alias(next_time_col)]
    outputs += [nxt.getField(f"c{i}").alias(out) for i, out in enumerate(carry)]
    if gap_col:
        outputs.append(seconds_between(nxt.getField(_TIME), _col(time_col), time_type).alias(gap_col))
    return linked.select(*[_col(c) for c in df.columns], *outputs)


def _row_hash(df: DataFrame) -> Column:
    """64-bit hash over all columns by name; maps and variants, which have no hash, go in as JSON.

    Columns that the library adds on the way do not count, so that daily and bulk loads agree.
    """
    parts = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        if f.name.startswith("_db_"):
            continue
        nested = "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()
        if isinstance(f.dataType, T.UserDefinedType):
            continue
        parts.append(F.to_json(F.struct(_col(f.name).alias("v"))) if nested else _col(f.name))
    return F.xxhash64(*parts) if parts else F.lit(0).cast("long")


def event_pair(time_col: str, carry: Mapping[str, str]) -> Column:
    """What a row hands to its predecessor: its time and the carried columns, in ``carry`` order."""
    return F.struct(_col(time_col).alias(_TIME), *[_col(src).alias(f"c{i}") for i, src in enumerate(carry.values())])


def event_rank(time_col: str, tie_breakers: Sequence[str], row: Column) -> Column:
    """A struct that orders like the chain: a null time after any time, then the tie-breakers, then the row hash."""
    return F.struct(
        _col(time_col).isNull().alias("n"),
        _col(time_col).alias("t"),
        *[_col(c).alias(f"b{i}") for i, c in enumerate(tie_breakers)],
        row.alias("r"),
    )


def row_hash(df: DataFrame) -> Column:
    """The last resort of the chain's order: a hash over all columns of ``df``."""
    return _row_hash(df)


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right, strict=True)])


def _sizes(hot: DataFrame) -> tuple:
    """Number of hot keys, their rows and the rows of the largest."""
    return tuple(hot.agg(F.count(F.lit(1)), F.sum("_n"), F.max("_n")).first())


def _starts(df, hot, hot_count, most, keys, time_col, segment_rows) -> DataFrame | None:
    """First times of the segments of every hot key, stored; None where times alone cannot cut a key evenly."""
    time = ticks(_col(time_col), df.schema[time_col].dataType)
    pieces = -(-2 * most // segment_rows)
    size = int((2.3 * 2 * pieces) ** (1 / 0.9)) + 8
    if time is None or size > LONGEST_SKETCH or hot_count > MAX_BROADCAST_HOT_KEYS:
        return None
    named = [F.col(f"_db_k{i}") for i in range(len(keys))]
    rows = df.join(F.broadcast(hot), _same([_col(k) for k in keys], named))
    sketched = rows.groupBy(*named, "_n").agg(
        F.kll_sketch_agg_bigint(time, F.lit(size)).alias("sketch"), F.count_if(time.isNull()).alias("untimed")
    )
    # Ranks must be constants: those of the largest key, of which a smaller one takes every so many.
    ranks = F.lit([i / (pieces + 1) for i in range(1, pieces + 1)])
    quantiles = F.when(F.col("untimed") < F.col("_n"), F.kll_sketch_get_quantile_bigint("sketch", ranks))
    own = F.ceil(F.col("_n") * 2 / segment_rows).cast("int")
    picked = F.transform(
        F.sequence(F.lit(1), own), lambda i: F.col("all_cuts")[F.round(i * (pieces + 1) / (own + 1)).cast("int") - 1]
    )
    found = sketched.select(*named, "_n", "untimed", quantiles.alias("all_cuts"))
    found = found.select(*named, "untimed", F.when(F.col("all_cuts").isNotNull(), picked).otherwise(F.array().cast("array<long>")).alias("cuts"))
    found = materialize(found, "segment-starts")
    # three equal cuts in a row: one time holds more than a segment
    crowded = F.exists(F.sequence(F.lit(2), F.size("cuts") - 1), lambda i: F.col("cuts")[i] == F.col("cuts")[i - 2])
    crowded = F.coalesce((F.size("cuts") > 2) & crowded, F.lit(False)) | (F.col("untimed") > segment_rows)
    if not found.where(crowded).isEmpty():
        return None
    return found.select(*named, F.array_distinct("cuts").alias("_db_starts"))


def _segment_lead(base, starts, keys, time, order) -> DataFrame:
    """Lead per (key, segment); rows of a segment's first time, and null times, are candidates of the one before."""
    named = [F.col(f"_db_k{i}") for i in range(len(keys))]
    kcols = [_col(k) for k in keys]
    met = base.withColumn("_db_time", time).join(F.broadcast(starts), _same(kcols, named), "left")
    begun = F.aggregate(  # first times up to the row's own, found by halves
        F.lit(_HALVES),
        F.lit(0),
        lambda n, step: n + F.when(F.get("_db_starts", n + step - 1) <= F.col("_db_time"), step).otherwise(0),
    )
    met = met.withColumn(
        _SEG,
        F.when(F.col("_db_starts").isNull(), 0).when(F.col("_db_time").isNull(), F.size("_db_starts") + 1).otherwise(begun),
    )
    first = F.col("_db_starts").isNotNull() & (
        F.col("_db_time").isNull() | (F.get("_db_starts", F.col(_SEG) - 1) == F.col("_db_time"))
    )
    places = F.when(F.coalesce(first, F.lit(False)), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    placed = met.withColumn("_db_ahead", F.explode(places)).withColumn(_SEG, F.col(_SEG) - F.col("_db_ahead"))
    linked = placed.withColumn(_NEXT, F.lead(_PAIR, 1).over(Window.partitionBy(*kcols, F.col(_SEG)).orderBy(*order)))
    return linked.where("_db_ahead = 0").select(*[_col(c) for c in base.columns], F.col(_NEXT))


def _ranges(hot_rows: DataFrame, segments: int, keys, time_col, tie_breakers) -> DataFrame:
    """Rows of hot keys with the number of their range of the full order.

    Copies of one row are told apart by a running number, so that even a row
    that occurs more often than a range holds is dealt to several ranges.
    """
    dealt = hot_rows.withColumn("_db_copy", F.monotonically_increasing_id()).repartitionByRange(
        segments,
        *[_col(k).asc() for k in keys],
        _col(time_col).asc_nulls_last(),
        *[_col(c).asc() for c in tie_breakers],
        F.col(_ROW).asc(),
        F.col("_db_copy").asc(),
    )
    return materialize(dealt.drop("_db_copy").withColumn(_SEG, F.spark_partition_id()), "ranges")


def _split_lead(base, hot, hot_count, segments, keys, time_col, tie_breakers, order) -> DataFrame:
    hot_keys = hot.drop("_n")
    if hot_count <= MAX_BROADCAST_HOT_KEYS:
        hot_keys = F.broadcast(hot_keys)
    kcols = [_col(k) for k in keys]
    is_hot = _same(kcols, [F.col(f"_db_k{i}") for i in range(len(keys))])
    cold = base.join(hot_keys, is_hot, "left_anti")
    cold = cold.withColumn(_NEXT, F.lead(_PAIR, 1).over(Window.partitionBy(*kcols).orderBy(*order)))

    seg = _ranges(base.join(hot_keys, is_hot, "left_semi"), segments, keys, time_col, tie_breakers)
    in_segment = seg.withColumn(_NEXT, F.lead(_PAIR, 1).over(Window.partitionBy(*kcols, F.col(_SEG)).orderBy(*order)))
    # First row of every range of a key, in the order of the window.
    rank = event_rank(time_col, tie_breakers, F.col(_ROW))
    named = [_col(k).alias(f"_db_h{i}") for i, k in enumerate(keys)]
    heads = seg.groupBy(*named, F.col(_SEG).alias("_db_hseg")).agg(F.min_by(F.col(_PAIR), rank).alias("_head"))
    hcols = [F.col(f"_db_h{i}") for i in range(len(keys))]
    following = F.lead("_head", 1).over(Window.partitionBy(*hcols).orderBy(F.col("_db_hseg")))
    next_heads = heads.select(*hcols, "_db_hseg", following.alias("_next_head"))
    joined = in_segment.join(next_heads, _same([*kcols, F.col(_SEG)], [*hcols, F.col("_db_hseg")]), "left")
    linked = joined.withColumn(_NEXT, F.coalesce(F.col(_NEXT), F.col("_next_head")))
    return cold.unionByName(linked.select(*[_col(c) for c in cold.columns]))
