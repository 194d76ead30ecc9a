"""Best-fit-decreasing packing of token pieces into sequences of fixed capacity.

Documents are encoded and cut into pieces on the executors. Best fit looks at lengths alone, and
there are at most ``capacity`` of them: the driver gets the count of each length, packs whole
groups of equal pieces exactly as piece-by-piece best-fit decreasing would, and sends back where
the first, second, .. piece of each length goes. Both are bounded by the capacity, not by the
number of documents. Tasks then place their pieces by their rank among the pieces of one length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybridge.llm.text import TOKEN_BYTES, column, give_back, load_tokenizer, runs, token_ids
from daybridge.sources.scratch import scratch_path

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"
PLACED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"
#: Ids of small vocabularies take two bytes each on disk and in shuffles; results have four.
SHORT_IDS = 1 << 16
#: Pieces of one length that are ranked together by one task.
RANKED_TOGETHER = 100_000


class OpenBins:
    """Open bins by remaining capacity, under a segment tree that finds the tightest fit in O(log capacity)."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = np.zeros(2 * self.size, dtype=bool)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def _mark(self, left: int) -> None:
        node, tree = left + self.size, self.tree
        tree[node] = bool(self.ranges[left])
        while node > 1:
            node //= 2
            tree[node] = tree[2 * node] or tree[2 * node + 1]

    def put(self, left: int, first: int, count: int) -> None:
        """Open bins ``first``.. with ``left`` tokens free; full bins are closed."""
        if left > 0 and count > 0:
            self.ranges[left].append((first, count))
            self._mark(left)

    def take(self, left: int, count: int) -> tuple[int, int]:
        """At most ``count`` bins with ``left`` tokens free, as one range of numbers."""
        first, have = self.ranges[left].pop()
        if have > count:
            self.ranges[left].append((first + count, have - count))
            have = count
        self._mark(left)
        return first, have

    def tightest(self, need: int) -> int:
        """The smallest free capacity of at least ``need`` that an open bin has, or 0."""
        node, tree = need + self.size, self.tree
        if not tree[node]:
            while node > 1 and not (node % 2 == 0 and tree[node + 1]):
                node //= 2
            if node <= 1:
                return 0
            node += 1
            while node < self.size:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        return node - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Placement of ``counts[length]`` pieces, longest first, each into the tightest open bin.

    Rows (length, first rank, pieces per bin, first bin, offset in the bin), by length and rank. A
    bin that takes one piece and still has room for another of that length is then the tightest
    one, so a group of equal bins takes equal groups of equal pieces: one step for all of them.
    """
    bins, used, plan = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        todo, rank = counts[length], 0
        while todo:
            left = bins.tightest(length)
            each = min(todo, (left or capacity) // length)
            if left:
                first, have = bins.take(left, todo // each)
            else:
                left, first, have = capacity, used, todo // each
                used += have
            plan.append((length, rank, each, first, capacity - left))
            bins.put(left - each * length, first, have)
            rank += have * each
            todo -= have * each
    plan.sort()
    return np.array(plan, dtype=np.int64).reshape(-1, 5)


def place(plan: np.ndarray, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of pieces given by length and rank."""
    big = np.int64(1) << np.int64(44)  # ranks stay below; a length times this still fits
    row = plan[np.searchsorted(plan[:, 0] * big + plan[:, 1], lengths * big + ranks, side="right") - 1]
    nth = ranks - row[:, 1]
    return row[:, 3] + nth // row[:, 2], row[:, 4] + nth % row[:, 2] * lengths


def id_type(tokenizer: str, end_id: int) -> str:
    return "<u2" if max(load_tokenizer(tokenizer).get_vocab_size(), end_id + 1) <= SHORT_IDS else "<u4"


def widened(blob: pa.Array, kind: str) -> pa.Array:
    """Binary ids of ``kind`` as little-endian unsigned 32-bit integers."""
    if kind == "<u4":
        return blob
    off = np.frombuffer(blob.buffers()[1], dtype=np.int32)[blob.offset : blob.offset + len(blob) + 1].astype(np.int64)
    raw = np.frombuffer(blob.buffers()[2], dtype=kind, count=int(off[-1] - off[0]) // 2, offset=int(off[0]))
    bounds = ((off - off[0]) * 2).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(blob), [None, pa.py_buffer(bounds), pa.py_buffer(raw.astype("<u4"))])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document: ids (of ``id_type``) with the end id, cut into ``capacity`` tokens, the first shorter."""

    kind = np.dtype(id_type(tokenizer, end_id))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for run in runs(batches, "text", TOKEN_BYTES):
            ids, off = token_ids(column(run, "text"), tokenizer)
            n = len(off) - 1
            full = np.empty(len(ids) + n, dtype=kind)
            ends = off[1:] + np.arange(n)
            inside = np.ones(len(full), dtype=bool)
            inside[ends] = False
            full[inside], full[ends] = ids, end_id
            begin, total = off[:-1] + np.arange(n), np.diff(off) + 1
            count = -(-total // capacity)
            doc = np.repeat(np.arange(n), count)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            first = total - (count - 1) * capacity
            start = np.where(nth == 0, 0, first[doc] + (nth - 1) * capacity)
            length = np.where(nth == 0, first[doc], capacity)
            bounds = np.r_[begin[doc] + start, len(full)] * kind.itemsize
            blob = pa.Array.from_buffers(
                pa.large_binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(full)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    column(run, "doc_id").take(pa.array(doc)),
                    pa.array(nth.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    blob,
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(work, PIECE_SCHEMA)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens by best-fit decreasing.

    Returns a row per piece: doc_id, piece, start (the document's tokens before it), length, ids
    (little-endian unsigned 32-bit, binary), sequence_id, offset. A null or empty text is the end
    id alone. Rows that share a doc_id, null included, are packed each for itself. Columns other
    than the two named are ignored. An empty table gives no pieces.

    The pieces are written once below ``spark.checkpoint.dir``: counts and placement see the same
    rows, also when an executor is lost in between.
    """
    spark = docs.sparkSession
    kind = id_type(tokenizer, end_id)
    path = scratch_path(spark, "pieces")
    token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col).write.parquet(path)
    pieces = spark.read.schema(PIECE_SCHEMA).parquet(path)
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = best_fit_plan(counts, capacity)

    parts = max(1, -(-max(counts.values(), default=0) // RANKED_TOGETHER)) * 8
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(parts)).cast("int"))
    before = (
        dealt.groupBy("length", "part")
        .count()
        .withColumn(
            "before",
            F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("length", "part", F.coalesce("before", F.lit(0)).alias("before"))
    )
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids")
    ranked = (
        dealt.withColumn("nth", F.row_number().over(order).cast("long") - 1)
        .join(before, ["length", "part"])
        .select("doc_id", "piece", "start", "length", "ids", (F.col("nth") + F.col("before")).alias("rank"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in runs(batches, "ids", TOKEN_BYTES):
            lengths = column(batch, "length").to_numpy(zero_copy_only=False)
            seq, at = place(plan, lengths, column(batch, "rank").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], widened(batch.column(4), kind), pa.array(seq), pa.array(at)],
                names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(work, PLACED_SCHEMA)


def packed_sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences: sequence_id, n_tokens, ids (binary), doc_ids, offsets. A group holds one capacity at most."""
    by_offset = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return (
        placed.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), by_offset.alias("p"))
        .select(
            "sequence_id",
            "n_tokens",
            F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
            F.col("p.doc_id").alias("doc_ids"),
            F.col("p.offset").alias("offsets"),
        )
    )


def with_crc32(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Replace a binary column of ids by ids_crc32, the unsigned crc32 of its bytes."""
    return df.withColumn("ids_crc32", F.crc32(ids_col)).drop(ids_col)


def crc32_of(values: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(values, dtype="<u4"))
