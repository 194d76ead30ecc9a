"""Daily load into a date-partitioned table, with the day boundary repaired.

The last event of day D-1 only learns its successor when day D arrives. A daily
load therefore reads partition D-1 back, unions it with day D, recomputes the
next event over both days and overwrites exactly partitions D-1 and D.

``bulk_bridge`` gives, in one job, what loading every day of a history in
ascending order gives. Both chain rows in the same total order (see
``add_next_event``), so a day gives the same table from any input layout.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.operators.next_event import DEFAULT_SEGMENT_ROWS, add_next_event
from daybridge.plans.heads import bridge_by_heads, find_ends, heads_apply, plain_session
from daybridge.sources.scratch import folder_bytes, free, scratch_path
from daybridge.sources.tables import (
    FileLayout,
    by_files,
    create_partitioned_table,
    overwrite_partitions,
    partition_columns,
    read_partitions,
    table_exists,
    table_location,
)

_ROLE = "_db_role"  # 0: row is written back, 1: row is only a successor candidate
_NEXT_DAY = "_db_next_day"
_GROUP, _OWNER = "_db_group", "_db_owner"
# The days of a batch are collected on the driver; more than this many (270
# years) are taken for dirty dates and refused.
MAX_DAYS = 100_000


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class BridgeSpec:
    """Which rows are chained and how the table is partitioned.

    The defaults are those of the flight load: next departure per origin
    airport, carrying the airline, partitioned by flight date.
    """

    keys: Sequence[str] = ("Origin",)
    time_col: str = "FlightTime"
    carry: Mapping[str, str] = field(default_factory=lambda: {"Airline_next": "Reporting_Airline"})
    tie_breakers: Sequence[str] = ()
    partition_col: str = "FlightDate"
    next_time_col: str | None = None
    gap_col: str | None = "diff_next"
    lookback_days: int = 1
    strategy: str = "auto"
    segment_rows: int = DEFAULT_SEGMENT_ROWS
    #: Bytes of the day before from which on a daily load leaves its chain as it is and bridges it by heads.
    heads_from_bytes: int = 64 << 20

    @property
    def next_col(self) -> str:
        return self.next_time_col or f"{self.time_col}_next"

    @property
    def added_columns(self) -> list[str]:
        return [self.next_col, *self.carry, *([self.gap_col] if self.gap_col else [])]


def bridge_next_event(df: DataFrame, spec: BridgeSpec) -> DataFrame:
    """Next event per key, kept only if it lies at most ``lookback_days`` days later."""
    carry = {**spec.carry, _NEXT_DAY: spec.partition_col}
    linked = add_next_event(
        df,
        list(spec.keys),
        spec.time_col,
        carry,
        list(spec.tie_breakers),
        next_time_col=spec.next_col,
        gap_col=spec.gap_col,
        strategy=spec.strategy,
        segment_rows=spec.segment_rows,
    )
    within = ~(F.datediff(F.col(_NEXT_DAY), F.col(_quote(spec.partition_col))) > F.lit(spec.lookback_days))
    kept = [F.when(within, F.col(_quote(c))).alias(c) for c in spec.added_columns]
    return linked.select(*[F.col(_quote(c)) for c in df.columns], *kept)


# Above this many days per write, rows are regrouped by day first, so that each
# day is written by a few tasks instead of every task writing a file per day.
REGROUP_ABOVE_DAYS = 4


def _file_layout(out: DataFrame, pcol: str, output_partitions: int | None, many_days: bool) -> DataFrame:
    """Order columns for the table (partition column last) and pick the write layout."""
    out = out.select(*[F.col(_quote(c)) for c in out.columns if c != pcol], F.col(_quote(pcol)))
    if output_partitions:
        return out.hint("rebalance", output_partitions, pcol)
    if many_days:
        # Adaptive execution splits a large day into evenly sized files.
        return out.hint("rebalance", pcol)
    return out


def _added_types(batch: DataFrame, spec: BridgeSpec) -> dict[str, T.DataType]:
    types = {spec.next_col: batch.schema[spec.time_col].dataType}
    types |= {out: batch.schema[src].dataType for out, src in spec.carry.items()}
    return types | ({spec.gap_col: T.LongType()} if spec.gap_col else {})


def _check_table(table: str, batch: DataFrame, spec: BridgeSpec) -> None:
    """Refuse a batch that the table cannot hold whole, and a table that is not partitioned as the load needs."""
    spark = batch.sparkSession
    parts = partition_columns(spark, table)
    if [p.lower() for p in parts] != [spec.partition_col.lower()]:
        raise ValueError(f"table {table} must be partitioned by {spec.partition_col!r} alone, not by {parts}")
    expected = {f.name: f.dataType for f in batch.schema.fields} | _added_types(batch, spec)
    actual = {f.name: f.dataType for f in spark.read.table(table).schema.fields}
    missing = sorted(set(actual) - set(expected))
    extra = sorted(set(expected) - set(actual))
    changed = sorted(
        f"{n}: {actual[n].simpleString()} -> {expected[n].simpleString()}"
        for n in set(actual) & set(expected)
        if actual[n] != expected[n]
    )
    if missing or extra or changed:
        raise ValueError(
            f"batch does not match the table: missing {missing}, new {extra}, type changes {changed}"
        )


def _checked_days(days: dict, pcol: str) -> dict:
    if None in days:
        raise ValueError(f"batch has rows with a null {pcol!r}")
    if len(days) > MAX_DAYS:
        raise ValueError(f"batch has more than {MAX_DAYS} distinct values of {pcol!r}")
    return dict(sorted(days.items()))


def _days_of(batch: DataFrame, spec: BridgeSpec) -> dict:
    """Days of a batch in order, with their rows: one row per day reaches the driver. Null and absurdly many days are refused."""
    pcol = spec.partition_col
    return _checked_days(dict(batch.groupBy(F.col(_quote(pcol))).count().limit(MAX_DAYS + 1).collect()), pcol)


@dataclass
class Staged:
    """A batch written below the checkpoint folder, with what the writing tasks saw of it."""

    rows: DataFrame
    path: str
    days: list
    count: int


def stage(batch: DataFrame, spec: BridgeSpec) -> Staged:
    """Write a batch once, as Parquet in the shared scratch folder, and note its days and rows on the way: one job.

    Whatever reads the batch later reads these files, also after lost executors, so that its source is parsed once.
    """
    spark, pcol = batch.sparkSession, F.col(_quote(spec.partition_col))
    seen, path = Observation("batch"), scratch_path(spark, "batch")
    counted = batch.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(pcol.isNull()).alias("undated"), F.collect_set(pcol).alias("days")
    )
    counted.write.parquet(path)
    got = seen.get
    days = dict.fromkeys(got["days"], 0) | ({None: 0} if got["undated"] else {})
    try:
        days = _checked_days(days, spec.partition_col)
    except ValueError:
        free(spark, path)
        raise
    return Staged(spark.read.schema(batch.schema).parquet(path), path, list(days), got["rows"])


def load_day(
    batch: DataFrame,
    table: str,
    spec: BridgeSpec = BridgeSpec(),
    *,
    location: str | None = None,
    lookahead_days: int = 0,
    output_partitions: int | None = None,
    files: FileLayout | None = None,
    merge: bool = False,
    before_commit: Callable[[], None] | None = None,
) -> list:
    """Load a batch (one day or several) into ``table`` and repair the day boundary.

    * The batch is written to the scratch folder once and read from there (its
      days are noted on the way); the files go after the commit. An empty batch
      is a no-op and a null partition date is refused.
    * A batch of one day meets a large day before by its first row per key
      (see ``plans/heads.py``): D-1 is not sorted again. A day before of less than
      ``spec.heads_from_bytes`` is chained anew with the batch, which is quicker;
      the table is the same. Five jobs run either way.
    * A batch holds its days whole: rows of these days that the table has are
      replaced. With ``merge`` they are kept and the batch is added to them (a
      batch that is merged twice is in the table twice).
    * For each batch day D, partitions D-1 .. D-``lookback_days`` already in the
      table are read back (partition pruning), their old next-event columns
      dropped, and unioned with the batch by column name.
    * ``lookahead_days`` > 0 also reads D+1 .. as successor candidates only, so
      reloading an old day keeps its tails; those partitions are not rewritten.
    * The next event is computed over the union and exactly the batch days and
      the days read back are overwritten (dynamic partition overwrite); other
      partitions are untouched. A new table is created partitioned by the
      partition column, managed or at ``location``.
    * A batch of several days gives what loading its days one by one in
      ascending order gives, whatever the times (see ``bulk_bridge``).
    * ``output_partitions`` adds a rebalance step into that many partitions
      by day. Batches of more than ``REGROUP_ABOVE_DAYS`` days are regrouped
      by day anyway; a daily batch is written straight from the window stage.
    * ``files`` sets the number of files of every day written instead, by bytes
      or rows (see ``FileLayout``).
    * ``before_commit`` runs when the batch has been read whole and nothing is
      written yet; what it raises ends the load.

    One writer per table at a time. Returns the sorted batch days plus the
    previous days that were read back (a day read back without rows stays absent).
    """
    _check_batch(batch, table, spec)
    staged = stage(batch, spec)
    try:
        if before_commit:
            before_commit()  # also for an empty batch: all its lines may be bad
        return _load(staged, table, spec, location, lookahead_days, output_partitions, files, merge)
    finally:
        free(batch.sparkSession, staged.path)


def _check_batch(batch: DataFrame, table: str, spec: BridgeSpec) -> None:
    pcol = spec.partition_col
    if not isinstance(batch.schema[pcol].dataType, T.DateType):
        raise TypeError(f"partition column {pcol!r} must be a date")
    for c in spec.added_columns:
        if c in batch.columns:
            raise ValueError(f"batch already has output column {c!r}")
    if table_exists(batch.sparkSession, table):
        _check_table(table, batch, spec)


def _day_bytes(spark, table: str, pcol: str, day) -> int:
    """Bytes of the table's folder of the day before ``day``."""
    return folder_bytes(spark, f"{table_location(spark, table)}/{pcol}={day - timedelta(days=1)}")


def _load_by_heads(staged: Staged, table: str, spec: BridgeSpec) -> tuple[DataFrame, str]:
    """One day and the day before, chained by the first rows of the day; and the scratch folder that this reads."""
    batch, spark, pcol = staged.rows, staged.rows.sparkSession, spec.partition_col
    day = staged.days[0]
    quiet = plain_session(spark)
    read = lambda s, back: read_partitions(s, table, pcol, [day - timedelta(days=back)])
    ends = find_ends(quiet.read.schema(batch.schema).parquet(staged.path), read(quiet, 1), read(quiet, 2), spec)
    fits = spec.strategy == "auto" and staged.count + ends.broken_rows <= spec.segment_rows
    return bridge_by_heads(batch, read(spark, 1), ends, spec, "window" if fits else spec.strategy), ends.path


def _load(staged: Staged, table, spec, location, lookahead_days, output_partitions, files, merge) -> list:
    batch, days, rows = staged.rows, staged.days, staged.count
    spark, pcol = batch.sparkSession, spec.partition_col
    exists = table_exists(spark, table)
    if not days:
        return []
    alone = exists and len(days) == 1 and spec.lookback_days == 1 and not lookahead_days and not merge
    if alone and heads_apply(batch, spec) and _day_bytes(spark, table, pcol, days[0]) >= spec.heads_from_bytes:
        out, path = _load_by_heads(staged, table, spec)
        before = days[0] - timedelta(days=1)
        try:
            _write(out, staged, table, spec, [before, *days], True, location, output_partitions, files)
        finally:
            free(spark, path)
        return [before, *days]

    role = {0: [], 1: []}  # days read from the table: written back, or successor candidates only
    loads = set(days)
    if exists:
        near = lambda n, sign: {d + timedelta(days=sign * k) for d in days for k in range(1, n + 1)}
        back = near(spec.lookback_days, -1) - loads
        ahead = near(lookahead_days, 1) - loads - back
        role = {0: sorted(back | (loads if merge else set())), 1: sorted(ahead)}
        loads |= ahead
    parts = [batch.withColumn(_ROLE, F.lit(0))]
    for r, wanted in role.items():
        if wanted:
            stored = read_partitions(spark, table, pcol, wanted).select(*[F.col(_quote(c)) for c in batch.columns])
            rows += stored.count() if spec.strategy == "auto" and rows <= spec.segment_rows else 0  # from file footers
            parts.append(stored.withColumn(_ROLE, F.lit(r)))
    if spec.strategy == "auto" and rows <= spec.segment_rows:
        spec = replace(spec, strategy="window")  # no key can have more rows: need not count them
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), parts)

    written = sorted(set(days) | set(role[0]))
    span = [*written, *role[1]]
    if (max(span) - min(span)).days <= spec.lookback_days:
        # All rows form the union of one load.
        linked = bridge_next_event(union, spec)
    else:
        linked = bulk_bridge(union, spec, load_days=sorted(loads), present=sorted(span))
    out = linked.where(F.col(_ROLE) == 0).drop(_ROLE)
    _write(out, staged, table, spec, written, exists, location, output_partitions, files)
    return written


def _write(out, staged, table, spec, written, exists, location, output_partitions, files) -> None:
    pcol = spec.partition_col
    if files:
        ordered = out.select(*[F.col(_quote(c)) for c in out.columns if c != pcol], F.col(_quote(pcol)))
        out = by_files(ordered, pcol, files, staged.path, staged.count)
    else:
        out = _file_layout(out, pcol, output_partitions, len(written) > REGROUP_ABOVE_DAYS)
    if exists:
        overwrite_partitions(out, table)
    else:
        create_partitioned_table(out, table, pcol, location=location, regroup=False)


def _advances(df: DataFrame, spec: BridgeSpec) -> bool:
    """Whether every row has a time and, within a key, a later day never holds an earlier or equal time.

    One aggregate by (key, day), then one over its rows; a single row reaches the driver.
    """
    keys = [F.col(_quote(k)).alias(f"_db_k{i}") for i, k in enumerate(spec.keys)]
    time, day = F.col(_quote(spec.time_col)), F.col(_quote(spec.partition_col))
    per_day = df.groupBy(*keys, day.alias("_db_d")).agg(
        F.min(time).alias("lo"), F.max(time).alias("hi"), F.count(F.when(time.isNull(), 1)).alias("nulls")
    )
    before = F.lag("hi").over(Window.partitionBy(*[f"_db_k{i}" for i in range(len(keys))]).orderBy("_db_d"))
    bad = per_day.select("lo", "nulls", before.alias("hi")).where("nulls > 0 or hi >= lo")
    return bad.isEmpty()


def bulk_bridge(
    df: DataFrame, spec: BridgeSpec = BridgeSpec(), *, load_days: list | None = None, present: list | None = None
) -> DataFrame:
    """What loading the days of ``df`` in ascending order gives, in one job.

    A day's rows keep the values of the last load that read them: the latest
    load day within ``lookback_days`` after it. That load's union holds the days
    up to ``lookback_days`` before it. ``load_days`` are the days that are
    loaded (default: all days of ``df``, which ``present`` may give).

    If each day is read again by the last load that could read it, all times are
    there and they advance from day to day within each key (one aggregate
    decides), every load's chain is a part of the chain over all days: one pass,
    a successor more than ``lookback_days`` days later dropped. Otherwise each row goes into each load's union that holds its
    day (``lookback_days + 1`` at most) and each union is chained for itself.
    Both give the same result. Null dates are refused.
    """
    spark = df.sparkSession
    pcol = spec.partition_col
    days = sorted(present) if present is not None else list(_days_of(df, spec))
    loads = sorted(load_days) if load_days is not None else days
    near = {d: [d + timedelta(days=k) for k in range(spec.lookback_days + 1)] for d in days}
    loaded, have = set(loads), set(days)
    owner = {d: max((x for x in near[d] if x in loaded), default=d) for d in days}
    followed = all(owner[d] == max(x for x in near[d] if x in have) for d in days)
    if followed and _advances(df, spec):
        return bridge_next_event(df, spec)

    unions = set(owner.values())
    membership = [(d, x, x == owner[d]) for d in days for x in near[d] if x in unions]
    groups = spark.createDataFrame(membership, f"_db_day date, {_GROUP} date, {_OWNER} boolean")
    rows = df.join(F.broadcast(groups), F.col(_quote(pcol)) == F.col("_db_day")).drop("_db_day")  # a row per day and load
    linked = add_next_event(
        rows,
        [*spec.keys, _GROUP],
        spec.time_col,
        dict(spec.carry),
        list(spec.tie_breakers),
        next_time_col=spec.next_col,
        gap_col=spec.gap_col,
        strategy=spec.strategy,
        segment_rows=spec.segment_rows,
    )
    return linked.where(F.col(_OWNER)).drop(_GROUP, _OWNER)


def bulk_load(
    df: DataFrame,
    table: str,
    spec: BridgeSpec = BridgeSpec(),
    *,
    location: str | None = None,
    output_partitions: int | None = None,
    files: FileLayout | None = None,
) -> list:
    """Load a whole history into ``table`` in one job; its days replace existing partitions.

    Days of the table just before days of the history are read back and rewritten, and days just
    after them are read as successor candidates, so that a history loaded into the middle of a
    table joins on both sides. ``df`` is read several times (days, time check, key counts, main
    pass): hand over stored data, not an expensive plan. Returns the days written.
    """
    _check_batch(df, table, spec)
    rows_of = _days_of(df, spec)
    given = Staged(df, "", list(rows_of), sum(rows_of.values()))
    return _load(given, table, spec, location, spec.lookback_days, output_partitions, files, False)
