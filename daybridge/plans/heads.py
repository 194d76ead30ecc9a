"""The day boundary by heads: day D's first row per key goes to the open end of day D-1, which is not sorted again.

Day D-1 is in the table with its chain. Where its times end before those of day D begin, nothing in that
chain changes but its end, the row without a successor or with one beyond the day. So one row per key is
enough: day D's first row (``head``), and of day D-1 a few numbers that tell whether its stored chain stands.
Keys where it does not go through the window again, both days together.

A stored chain stands if

* all its rows have a time,
* day D's first time comes after its last,
* day D-2 ends before it begins, so that the load of D-1 mixed no row of D-2 into it,
* the gaps to the stored successors add up from its first time to its last (or to the successor of the last
  row), and only the last row lacks a successor within the day. Gaps to other rows than the next add up to less.

Not noticed is a day D-2 that was replaced without ``lookahead_days`` after D-1 was loaded, where its former
rows had the very times of rows of D-1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.clock import seconds_between, ticks
from daybridge.operators.next_event import add_next_event, event_pair, event_rank, row_hash
from daybridge.sources.scratch import scratch_path

#: Heads are broadcast when at most so many keys need one; beyond, day D-1 is joined by a hash shuffle.
MAX_BROADCAST_HEADS = 200_000
_THIS, _STORED, _OLDER = 0, 1, 2


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _col(name: str) -> Column:
    return F.col(_quote(name))


@dataclass
class Ends:
    """Per key of day D-1 whose end changes: whether its chain ``stands``, its last time and day D's ``head``."""

    table: DataFrame
    path: str
    keys: int
    broken_rows: int


def heads_apply(batch: DataFrame, spec) -> bool:
    """Whether ends can be told from numbers: a time that counts, a hashable batch."""
    return ticks(F.lit(None), batch.schema[spec.time_col].dataType) is not None


def plain_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose queries run as one job each (no adaptive stages).

    For tables of one row per key, which have been summed before the shuffle: there is no skew to adapt to.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set("spark.sql.adaptive.enabled", "false")
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # both sides are dealt by key already
    other.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return other


def _named_keys(spec) -> list[Column]:
    return [_col(k).alias(f"_db_k{i}") for i, k in enumerate(spec.keys)]


def find_ends(batch: DataFrame, stored: DataFrame, older: DataFrame, spec) -> Ends:
    """Write the table of ends: one aggregate over each of the two days and one over the times of D-2.

    ``stored`` is D-1 with its chain, ``older`` D-2. All three may be read in any session; one job runs.
    """
    keys = [f"_db_k{i}" for i in range(len(spec.keys))]
    kind = batch.schema[spec.time_col].dataType
    time, after = ticks(_col(spec.time_col), kind), ticks(_col(spec.next_col), kind)
    own = F.when(F.col("_db_day") == _STORED, F.col("_db_t"))
    hangs = F.lit(False)
    for c in spec.carry:
        hangs = hangs | _col(c).isNotNull()
    rows = stored.select(
        *_named_keys(spec),
        F.lit(_STORED).alias("_db_day"),
        time.alias("_db_t"),
        after.alias("_db_n"),
        (after.isNull() & hangs).alias("_db_hangs"),
    ).unionByName(
        older.select(*_named_keys(spec), F.lit(_OLDER).alias("_db_day"), time.alias("_db_t")), allowMissingColumns=True
    )
    is_own = F.col("_db_day") == _STORED
    told = rows.groupBy(*keys).agg(
        F.count_if(is_own).alias("rows"),
        F.count_if(is_own & F.col("_db_t").isNull()).alias("untimed"),
        F.min(own).alias("first"),
        F.max(own).alias("last"),
        F.count_if(is_own & F.col("_db_n").isNull()).alias("open"),
        F.count_if(F.col("_db_hangs")).alias("hanging"),
        F.max("_db_n").alias("beyond"),
        F.try_sum(F.col("_db_n") - F.col("_db_t")).alias("gaps"),
        F.max(F.when(F.col("_db_day") == _OLDER, F.col("_db_t"))).alias("before"),
    ).where("rows > 0")
    rank = event_rank(spec.time_col, spec.tie_breakers, row_hash(batch))
    heads = batch.groupBy(*_named_keys(spec)).agg(
        F.min_by(event_pair(spec.time_col, spec.carry), rank).alias("head"), F.min(time).alias("starts")
    )
    named = heads.select(*[F.col(k).alias(f"{k}h") for k in keys], "head", "starts", F.lit(True).alias("has_head"))
    same = [F.col(k).eqNullSafe(F.col(f"{k}h")) for k in keys]
    met = told.join(named, same, "left")
    gaps = F.coalesce(F.col("gaps"), F.lit(0))
    one_open = (F.col("open") == 1) & F.coalesce(F.col("beyond") <= F.col("last"), F.lit(True)) & (gaps == F.col("last") - F.col("first"))
    all_led = (F.col("open") == 0) & (F.col("beyond") > F.col("last")) & (gaps == F.col("beyond") - F.col("first"))
    stands = (
        (F.col("untimed") == 0)
        & F.coalesce(F.col("last") < F.col("starts"), F.lit(True))
        & F.coalesce(F.col("before") < F.col("first"), F.lit(True))
        & (one_open | all_led)
    )
    ends = met.select(*keys, F.coalesce(stands, F.lit(False)).alias("stands"), "last", "head", "rows", "open", "hanging", "has_head")
    ends = ends.where("not stands or has_head or open = 0 or hanging > 0").drop("open", "hanging", "has_head")
    spark = batch.sparkSession
    path, seen = scratch_path(spark, "ends"), Observation("ends")
    ends = ends.observe(seen, F.count(F.lit(1)).alias("keys"), F.sum(F.when(~F.col("stands"), F.col("rows"))).alias("broken"))
    ends.drop("rows").coalesce(max(1, spark.sparkContext.defaultParallelism)).write.parquet(path)
    return Ends(spark.read.schema(ends.drop("rows").schema).parquet(path), path, seen.get["keys"], seen.get["broken"] or 0)


def bridge_by_heads(batch: DataFrame, stored: DataFrame, ends: Ends, spec, strategy: str) -> DataFrame:
    """Both days with their chain: columns of ``batch``, then the added ones.

    Rows of D-1 pass a join with the ends alone: no shuffle and no sort, but for keys whose chain does not stand.
    """
    kind = batch.schema[spec.time_col].dataType
    added = spec.added_columns
    names = [_quote(c) for c in batch.columns]
    found = ends.table.withColumnsRenamed({f"_db_k{i}": f"_db_e{i}" for i in range(len(spec.keys))})
    found = F.broadcast(found) if ends.keys <= MAX_BROADCAST_HEADS else found.hint("shuffle_hash")
    same = [_col(k).eqNullSafe(F.col(f"_db_e{i}")) for i, k in enumerate(spec.keys)]
    met = stored.select(*names, *[_quote(c) for c in added]).join(found, same, "left")

    after = ticks(_col(spec.next_col), kind)
    is_end = F.col("last").isNotNull() & (after.isNull() | (after > F.col("last")))
    head = F.col("head")
    new = {spec.next_col: head["t"]} | {out: head[f"c{i}"] for i, out in enumerate(spec.carry)}
    if spec.gap_col:
        new[spec.gap_col] = seconds_between(head["t"], _col(spec.time_col), kind)
    kept = met.where(F.coalesce(F.col("stands"), F.lit(True)))
    kept = kept.select(*names, *[F.when(is_end, new[c]).otherwise(_col(c)).alias(c) for c in added])

    rows = batch
    if ends.broken_rows:
        rows = batch.unionByName(met.where(~F.col("stands")).select(*names))
    linked = add_next_event(
        rows,
        list(spec.keys),
        spec.time_col,
        dict(spec.carry),
        list(spec.tie_breakers),
        next_time_col=spec.next_col,
        gap_col=spec.gap_col,
        strategy=strategy,
        segment_rows=spec.segment_rows,
    )
    return kept.unionByName(linked)
