"""Token ids as Parquet list columns, for selective reads.

Layout of a data set: ``data`` holds a row per document in ascending id order (file part-00000
before part-00001 ..), ``manifest`` a row per file with the tokens before it.

* ``tokens`` (list of int) is dictionary-encoded: ids below 2^16 take two bytes or less.
* ``doc_id``, ``part``, ``local_start``, ``n_tokens`` are delta-encoded (format version 2).
* Row groups and pages have a set size, and pages carry a column index, so that a range of
  documents or a read of metadata alone touches few pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybridge.llm.text import TOKEN_BYTES, column, runs, token_ids

DATA_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, tokens array<int>"
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 2_000


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every text, append ``end_id`` and write the data set in ascending id order.

    Null ids come first; rows that share an id follow one another in an order fixed by their text.
    A null or empty text is the end id alone. Columns other than the two named are ignored. Rows
    are dealt by ranges of (id, text hash), so that rows of one frequent id spread over files.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for run in runs(batches, "text", TOKEN_BYTES):
            ids, off = token_ids(column(run, "text"), tokenizer)
            n = len(off) - 1
            full = np.empty(len(ids) + n, dtype=np.int32)
            ends = off[1:] + np.arange(n)
            inside = np.ones(len(full), dtype=bool)
            inside[ends] = False
            full[inside], full[ends] = ids, end_id
            lens = np.diff(off) + 1
            bounds = np.r_[0, np.cumsum(lens)]
            yield pa.RecordBatch.from_arrays(
                [
                    column(run, "doc_id"),
                    pa.array(np.full(n, part, dtype=np.int32)),
                    pa.array(start + bounds[:-1]),
                    pa.array(lens),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(full)),
                ],
                names=["doc_id", "part", "local_start", "n_tokens", "tokens"],
            )
            start += int(bounds[-1])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = texts.repartitionByRange(files, *order).sortWithinPartitions(*order, "text").mapInArrow(work, DATA_SCHEMA)
    writer = (
        rows.write.option("parquet.writer.version", "v2")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary", "true")
    )
    for plain in ("doc_id", "part", "local_start", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{plain}", "false")
    writer.parquet(f"{path}/data")
    # A row per file: the running sum over files is small whatever the number of documents.
    sizes = spark.read.schema(DATA_SCHEMA).parquet(f"{path}/data").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")).write.parquet(
        f"{path}/manifest"
    )


def read_tokens(
    spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None, tokens: bool = True
) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens and, if wanted, tokens.

    Bounds on the id are pushed to the scan, which then skips row groups and pages; without
    ``tokens`` only the small delta-encoded columns are read.
    """
    data = spark.read.schema(DATA_SCHEMA).parquet(f"{path}/data")
    if first_id is not None:
        data = data.where(F.col("doc_id") >= first_id)
    if last_id is not None:
        data = data.where(F.col("doc_id") <= last_id)
    base = spark.read.schema("part int, n long, base long").parquet(f"{path}/manifest").select("part", "base")
    cols = ["doc_id", (F.col("local_start") + F.col("base")).alias("start"), "n_tokens", *(["tokens"] if tokens else [])]
    return data.join(F.broadcast(base), "part").select(*cols)  # one row per file


def token_digests(rows: DataFrame) -> DataFrame:
    """Replace tokens by ids_crc32: unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "tokens")
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")
            off = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return rows.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(
        work, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
