"""Partitioned catalog tables: existence, partition reads, writes and comments."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybridge.sources.scratch import folder_bytes, materialize


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def read_partitions(spark: SparkSession, table: str, partition_col: str, values: Iterable) -> DataFrame:
    """Rows of the listed partitions only; the predicate prunes the other folders."""
    return spark.read.table(table).where(F.col(_quote(partition_col)).isin(list(values)))


def column_comments(spark: SparkSession, table: str) -> dict[str, str | None]:
    """Column name -> catalog comment."""
    return {f.name: f.metadata.get("comment") for f in spark.read.table(table).schema.fields}


def _described(spark: SparkSession, table: str) -> dict:
    """What the catalog says of a table. A command, not a job: a listing of columns runs several."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").collect()[0][0])


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """A row per column: column_name, data_type, column_comment, is_partition, and the table's provider, kind and location."""
    told = _described(spark, table)
    parts, whole = set(partition_columns(spark, table)), (told.get("provider"), told.get("type"), told.get("location"))
    rows = [
        (f.name, f.dataType.simpleString(), f.metadata.get("comment"), f.name in parts, *whole)
        for f in spark.read.table(table).schema.fields
    ]
    names = "column_name string, data_type string, column_comment string, is_partition boolean"
    return spark.createDataFrame(rows, f"{names}, provider string, table_kind string, location string")


def table_location(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["location"].rstrip("/")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Names of the columns a table is partitioned by."""
    return list(_described(spark, table).get("partition_columns") or [])


def create_partitioned_table(
    df: DataFrame,
    table: str,
    partition_col: str,
    *,
    location: str | None = None,
    file_format: str = "parquet",
    regroup: bool = True,
) -> None:
    """Create (or replace) a table partitioned by ``partition_col``.

    Without ``location`` the table is managed (files under the warehouse);
    with it the files go to that folder. The partition column ends up last.
    ``regroup`` gathers the rows of a partition first (adaptive execution splits
    a large one into files of even size): without it every task writes a file
    for each partition it meets.
    """
    if regroup:
        df = df.hint("rebalance", F.col(_quote(partition_col)))
    writer = df.write.mode("overwrite").format(file_format).partitionBy(partition_col)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions present in ``df``; keep all others.

    Columns are matched to the table by name (then written by position); a
    column that either side lacks is an error, and so is a table without
    partitions, of which an overwrite would replace everything. The dynamic mode
    is an option of this one statement: no setting of the session changes, so
    that other threads' overwrites are what they ask for. It also lets ``df`` read partitions of ``table`` that it replaces,
    because new files are staged and old ones removed only when the job commits.
    """
    spark = df.sparkSession
    cols = spark.read.table(table).columns
    if not partition_columns(spark, table):
        raise ValueError(f"table {table} is not partitioned")
    extra, missing = sorted(set(df.columns) - set(cols)), sorted(set(cols) - set(df.columns))
    if extra or missing:
        raise ValueError(f"columns do not match table {table}: not in the table {extra}, missing {missing}")
    rows = df.select(*[F.col(_quote(c)) for c in cols])
    spark.sql(f"INSERT OVERWRITE {table} WITH ('partitionOverwriteMode' = 'dynamic') SELECT * FROM {{rows}}", rows=rows)


@dataclass(frozen=True)
class FileLayout:
    """How many files each written day gets: by the bytes a file should hold, or by its rows.

    Bytes are measured on the staged batch, as Parquet, and turned into rows per file.
    """

    file_bytes: int | None = None
    file_rows: int | None = None

    def rows_per_file(self, batch_bytes: int, batch_rows: int) -> int:
        if self.file_rows:
            return self.file_rows
        if not self.file_bytes:
            raise ValueError("a file layout needs file_bytes or file_rows")
        return max(1, int(self.file_bytes * batch_rows / max(1, batch_bytes)))


#: Rows that a task writes, unless its files are larger or the shuffle partitions are more: small files of several days share a task.
TASK_ROWS = 1_000_000


def by_files(df: DataFrame, partition_col: str, layout: FileLayout, staged_path: str, staged_rows: int) -> DataFrame:
    """Rows dealt so that every day is written as ceil(rows / rows per file) files of even size.

    Rows get a running number within their task, so that neither few distinct rows nor a hot key make a file larger, and
    go straight to the task of their file (``repartitionById``), which adaptive execution leaves as it is. A task may have
    files of several days, of a day one at most: the files of all days are dealt in turn to as many tasks as the day with the most
    files needs, and more where there is work for them (see ``TASK_ROWS``). The rows are
    written to the scratch folder first: the days are counted there.
    """
    spark, day = df.sparkSession, F.col(_quote(partition_col))
    size = folder_bytes(spark, staged_path) if layout.file_bytes else 0
    per_file = layout.rows_per_file(size, staged_rows)
    rows = materialize(df, "layout")
    files, first, n_rows = [], 0, 0
    for value, n in sorted(rows.groupBy(day).count().collect()):
        files.append((value, first, -(-n // per_file)))
        first += files[-1][2]
        n_rows += n
    if not files:
        return df
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // TASK_ROWS))
    tasks = max(min(first, wanted), *(f[2] for f in files), 1)
    dealt = spark.createDataFrame(files, f"_db_day {df.schema[partition_col].dataType.simpleString()}, _db_first int, _db_files int")
    numbered = rows.withColumn("_db_at", F.monotonically_increasing_id())
    met = numbered.join(F.broadcast(dealt), day == F.col("_db_day"))
    slot = F.col("_db_first") + F.pmod(F.col("_db_at"), F.col("_db_files")).cast("int")
    return met.repartitionById(tasks, F.pmod(slot, F.lit(tasks))).drop("_db_day", "_db_first", "_db_files", "_db_at")
