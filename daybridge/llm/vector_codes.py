"""Vector codes: product quantisation in whole numbers, over Hilbert-sorted flat blocks.

A vector's components become integers and are cut into equal parts; every part position has a codebook
that rounds of assigning and averaging improve. The parts of all vectors are laid out once, by part
position along a Hilbert curve, in flat blocks of a few hundred rows: integers one after another, with
the block's box (least and greatest component) and its sum. In each round the distances between a box
and the entries of the codebook leave a shortlist: an entry whose least distance to the box exceeds the
greatest distance of some other entry is nearest to no row. A block with a shortlist of one adds its sum
as a whole; the others run a small kernel of exact integers over rows and shortlist.

Spark scans the blocks once a round and sums per part and entry; the codebooks, parts x entries, are
all that the driver holds. Nothing depends on how rows are dealt to tasks: integers add up in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.tables import Tables
from daybridge.llm.text import column

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Rows of a block.
BLOCK_ROWS = 256
#: A label with more than one row in this many is hot; so there are fewer than this many hot labels.
HOT_SHARE = 1_000


@dataclass
class VectorCodes:
    """``rows``: id, label and other kept columns, code (an entry number per part) and error. ``books``: entries by part."""

    rows: DataFrame
    books: list[np.ndarray]

    def books_sha256(self) -> str:
        """Digest of all entries' decimal components by part, entry and position, joined by commas."""
        return sha256(",".join(str(x) for book in self.books for x in book.reshape(-1).tolist()).encode()).hexdigest()


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on a Hilbert curve of each row of a grid (rows x axes, values below 2 ** bits; bits x axes is at most 62).

    Axes are turned into the curve's transposed index in place: from the top bit down, each axis with the
    bit set flips the lower bits of the first axis and each other swaps them with it; a Gray code follows.
    """
    x = [np.ascontiguousarray(grid[:, i]).astype(np.int64) for i in range(grid.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(flip, low, swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, q = np.zeros(len(grid), dtype=np.int64), 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros(len(grid), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> b) & 1)
    return key


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Blocks x entries: whether an entry may be nearest to a row of the block, by the box low..high alone."""
    low, high, entry = low[:, None, :], high[:, None, :], book[None]
    near = np.maximum(np.maximum(low - entry, entry - high), 0)
    far = np.maximum(np.abs(entry - low), np.abs(entry - high))
    return (near * near).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1)[:, None]


def nearest(rows: np.ndarray, book: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest listed entry of each row (the lower number of equals) and its squared distance."""
    gap = rows[:, None, :] - book[listed][None]
    far = (gap * gap).sum(axis=2)
    at = far.argmin(axis=1)
    return listed[at], far[np.arange(len(rows)), at]


def _flat(binary: pa.Array, kind: type, width: int) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), dtype=kind).reshape(-1, width).astype(np.int64) for v in binary]


def _part_rows(parts: int, width: int, floor: int, spread: int) -> Callable:
    """A row per vector and part position, with its place on the curve."""
    axes = min(width, 31)
    bits = min(16, 62 // axes) if axes else 1
    shift = max(0, spread.bit_length() - bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            flat = column(batch, "ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n * parts, width)
            key = hilbert_keys((flat[:, :axes] - floor) >> shift, bits)
            row = np.repeat(column(batch, "row").to_numpy(zero_copy_only=False), parts)
            data = np.ascontiguousarray(flat.astype(np.int32))
            offsets = pa.py_buffer((np.arange(n * parts + 1) * 4 * width).astype(np.int32))
            values = pa.Array.from_buffers(pa.binary(), n * parts, [None, offsets, pa.py_buffer(data)])
            part = pa.array(np.tile(np.arange(parts, dtype=np.int32), n))
            yield pa.RecordBatch.from_arrays([part, pa.array(key), pa.array(row), values], names=["part", "place", "row", "ints"])

    return work


def _blocks(width: int) -> Callable:
    """Sorted rows cut into flat blocks: part, box, sum, rows and integers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = column(batch, "part").to_numpy(zero_copy_only=False)
            row = column(batch, "row").to_numpy(zero_copy_only=False)
            ints = np.frombuffer(b"".join(column(batch, "ints").to_pylist()), dtype=np.int32).reshape(-1, width)
            turns = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            starts = [s for a, b in zip(turns, np.r_[turns[1:], len(part)], strict=True) for s in range(a, b, BLOCK_ROWS)]
            ends = np.r_[starts[1:], len(part)]
            out = []
            for a, b in zip(starts, ends, strict=True):
                x = ints[a:b].astype(np.int64)
                box = np.stack([x.min(axis=0), x.max(axis=0), x.sum(axis=0)])
                out.append((int(part[a]), b - a, box.tobytes(), row[a:b].astype(np.int64).tobytes(), ints[a:b].tobytes()))
            names = ["part", "n", "box", "rows", "ints"]
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
            )

    return work


def _listed(batch: pa.RecordBatch, books: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part and sum of each block, and its shortlist as a row of flags."""
    part = column(batch, "part").to_numpy(zero_copy_only=False)
    boxes = np.frombuffer(b"".join(column(batch, "box").to_pylist()), dtype=np.int64).reshape(-1, 3, width)
    flags = np.zeros((len(part), max(len(b) for b in books)), dtype=bool)
    for p in np.unique(part):
        at = part == p
        flags[at, : len(books[p])] = shortlists(boxes[at, 0], boxes[at, 1], books[p])
    return part, boxes[:, 2], flags


def _sums(books: list[np.ndarray], width: int) -> Callable:
    """Rows and sums of each entry's own parts, over the blocks of a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((len(books), len(books[0])), np.int64)
        total = np.zeros((len(books), len(books[0]), width), np.int64)
        for batch in batches:
            part, sums, flags = _listed(batch, books, width)
            n = column(batch, "n").to_numpy(zero_copy_only=False)
            single = flags.sum(axis=1) == 1
            entry = flags.argmax(axis=1)
            np.add.at(count, (part[single], entry[single]), n[single])
            np.add.at(total, (part[single], entry[single]), sums[single])
            rest = np.flatnonzero(~single)
            for i, x in zip(rest, _flat(column(batch, "ints").take(pa.array(rest)), np.int32, width), strict=True):
                own, _ = nearest(x, books[part[i]], np.flatnonzero(flags[i]))
                np.add.at(count[part[i]], own, 1)
                np.add.at(total[part[i]], own, x)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    return work


def _assigned(books: list[np.ndarray], width: int) -> Callable:
    """Entry and squared distance of every part of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, _, flags = _listed(batch, books, width)
            rows = _flat(column(batch, "rows"), np.int64, 1)
            entry, error = [], []
            for i, x in enumerate(_flat(column(batch, "ints"), np.int32, width)):
                e, far = nearest(x, books[part[i]], np.flatnonzero(flags[i]))
                entry.append(e)
                error.append(far)
            size = [len(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(rows)[:, 0]),
                    pa.array(np.repeat(part, size).astype(np.int32)),
                    pa.array(np.concatenate(entry).astype(np.int32)),
                    pa.array(np.concatenate(error)),
                ],
                names=["row", "part", "entry", "error"],
            )

    return work


def _whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def encode_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: tuple[str, ...] = (),
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> VectorCodes:
    """Product codes of all vectors, and the codebooks they are written in.

    Rows whose vector is null or holds null or non-finite components are left out. A component x becomes
    floor(``scale`` * x). The codebook of a part position starts as that part of the rows with the least ids
    (null ids last; of equal ids the lesser vector first), ``entries`` at most; each round assigns every part to
    its nearest entry (ties: the lower number) and replaces an entry by the floored mean of its parts. An entry without parts stays.

    ``rows`` has the id, the ``keep`` columns, ``code`` and ``error`` (squared distances summed over the parts);
    repeated ids and repeated rows each have a row of their own, an empty table gives no row and no entry. Columns not named are
    not read. Vectors of unequal length, of a length that ``parts`` does not divide, or with components so large that a
    squared distance passes 62 bits are refused with a ValueError.
    """
    spark = vectors.sparkSession
    good = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    taken = vectors.where(F.col(vector_col).isNotNull() & F.coalesce(good, F.lit(False)))
    steps = Tables(spark)
    taken = steps.keep(
        "vectors",
        taken.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)],
            _whole_numbers(F.col(vector_col), scale).alias("ints"),
        ),
    )
    size = F.size("ints")
    shape = taken.agg(
        F.count("*"), F.min(size), F.max(size), F.min(F.array_min("ints")), F.max(F.array_max("ints"))
    ).first()
    named = [F.col("id").alias(id_col), *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)]]
    n, short, long, floor, top = shape
    if not n or not long:
        if long != short:
            raise ValueError(f"vectors have {short} to {long} components")
        rows = taken.select(*named, F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error"))
        return VectorCodes(rows, [])
    if short != long or long % parts:
        raise ValueError(f"vectors need one length that {parts} divides, not {short} to {long}")
    width = long // parts
    if (top - floor) ** 2 * long >= 1 << 62 or max(abs(floor), abs(top)) >= 1 << 31:
        raise ValueError(f"components from {floor} to {top} are too large for exact distances")

    first = taken.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    start = np.array([r.ints for r in first], dtype=np.int64).reshape(len(first), parts, width)
    books = [start[:, p].copy() for p in range(parts)]

    laid = taken.select("row", "ints").mapInArrow(
        _part_rows(parts, width, floor, max(1, top - floor)), "part int, place long, row long, ints binary"
    )
    laid = laid.repartitionByRange("part", "place", "row").sortWithinPartitions("part", "place", "row")
    blocks = steps.keep(
        "blocks", laid.mapInArrow(_blocks(width), "part int, n long, box binary, rows binary, ints binary")
    )
    for _ in range(rounds):
        own = blocks.select("part", "n", "box", "ints").mapInArrow(
            _sums(books, width), "part int, entry int, n long, sums array<long>"
        )
        added = own.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
        )
        books = [b.copy() for b in books]
        for r in added.collect():  # a row per part and entry
            books[r.part][r.entry] = [r[f"s{i}"] // r.n for i in range(width)]

    found = blocks.mapInArrow(_assigned(books, width), "row long, part int, entry int, error long")
    found = found.groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("part", "entry"))), lambda x: x["entry"]).alias("code"),
        F.sum("error").alias("error"),
    )
    return VectorCodes(taken.join(found, "row").select(*named, "code", "error"), books)


def code_text(code: Column) -> Column:
    """Entry numbers as text, two hex digits each."""
    return F.array_join(F.transform(code, lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")


def with_group_sum(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Each row with the sum of ``value`` over the rows of its group (nulls are one group).

    Sums are made before the shuffle. Groups with more than one row in ``HOT_SHARE``, of which there are fewer than
    that, meet their rows by broadcast; the others by a shuffle in which no group has more rows than that.
    """
    df = Tables(df.sparkSession).keep("group-rows", df)
    many = F.lit(df.count() // HOT_SHARE)
    totals = df.groupBy(F.col(group).alias("_g")).agg(F.sum(value).alias(out), F.count("*").alias("_n"))
    hot, cold = totals.where(F.col("_n") > many).drop("_n"), totals.where(F.col("_n") <= many).drop("_n")
    same = F.col(group).eqNullSafe(F.col("_g"))
    return (
        df.join(F.broadcast(hot), same)
        .union(df.join(F.broadcast(hot), same, "left_anti").join(cold, same))
        .drop("_g")
    )
