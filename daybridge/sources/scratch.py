"""Shared scratch space for intermediate tables and files.

On a cluster the only safe place for files that several executors (and a
retried task) must see is the shared folder named by ``spark.checkpoint.dir``.
It is read from the session; a folder of our own is only created for a local
master (tests, notebooks) where the setting is missing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only for local masters."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="daybridge-checkpoints-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/daybridge/{label}-{uuid.uuid4().hex}"


def unique_table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to a scratch folder and read it back.

    Later readers see the same rows, whatever is computed anew after a lost
    executor; column comments survive because the schema is handed on.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, by the file system's own summary; 0 if there is no such folder."""
    target, fs = _file_system(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, modification time in ms, bytes) of a file, or of the files below a folder that are no hidden ones."""
    target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return []
    found, out = fs.listFiles(target, True), []
    while found.hasNext():
        f = found.next()
        if not f.getPath().getName().startswith(("_", ".")):
            out.append((f.getPath().toString(), f.getModificationTime(), f.getLen()))
    return out


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of the one that is there."""
    target, fs = _file_system(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def free(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder made by :func:`scratch_path`; anything else is refused."""
    root = checkpoint_root(spark).rstrip("/")
    if not path.startswith(f"{root}/daybridge/"):
        raise ValueError(f"{path!r} is no scratch folder of this session")
    target, fs = _file_system(spark, path)
    fs.delete(target, True)
