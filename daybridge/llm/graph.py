"""Connected components of a graph given as an edge table, on Spark alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybridge.sources.scratch import scratch_path

#: Edges that one task contracts (16 bytes each).
EDGES_PER_TASK = 1_000_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the checkpoint folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as stars: each id but the smallest of its component, with that smallest id."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], least)
        np.minimum.at(after, label[b], least)
        while (after != after[after]).any():
            after = after[after]
        if (after == label).all():
            break
        label = after
    own = label != np.arange(len(ids))
    return ids[own], ids[label[own]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        u = np.concatenate([u, batch.column(0).to_numpy(zero_copy_only=False)])
        v = np.concatenate([v, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(u) > 2 * EDGES_PER_TASK:
            u, v = contracted(u, v)
    u, v = contracted(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of an edge (columns a, b); component is the smallest id it can reach.

    Tasks first contract the edges they hold, about ``EDGES_PER_TASK`` each, to stars; a graph that
    one task holds is done then. Otherwise large-star and small-star steps follow in turn: each
    hangs the neighbours of an id under the smallest of them, until the edges form stars. The steps
    are aggregates and equi-joins; a step count that grows with the logarithm of the longest path
    is all that runs in sequence. ``edges`` is counted first: hand over a stored table.
    """
    ends = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    tasks = -(-edges.count() // EDGES_PER_TASK)
    current = stored(ends.coalesce(max(1, tasks)).mapInArrow(_contract, "u long, v long"), "edges")
    if tasks > 1:
        current = _stars(current)
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _stars(current: DataFrame) -> DataFrame:
    state = None
    while True:
        both = current.union(current.select("v", "u"))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        hung = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        hung = hung.distinct()
        lowest = hung.groupBy("u").agg(F.min("v").alias("m"))
        pair = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        small = hung.join(lowest, "u").select(pair.alias("e")).select("e.u", "e.v").where("u != v").distinct()
        current = stored(small, "edges")
        now = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return current
        state = now
