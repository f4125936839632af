"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
#: A table of at most so many scan partitions, such as one small file, may be dealt to all cores.
FEW_PARTITIONS = 4
#: Bytes that may be sent to every task, and what an entry is taken to hold in memory there beside its own bytes.
MOST_SENT, ENTRY = 8_000_000, 40


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str, spread: bool = False) -> DataFrame:
    """Parquet table, projected at the scan so that column pruning reaches the files.

    ``spread``: a table of at most ``FEW_PARTITIONS`` scan partitions is dealt to all cores by its first
    column, if these are many more. A larger table is never moved, however many cores there are.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = df.select(*cols) if cols else df
    if not spread:
        return df
    cores, parts = spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(cores, cols[0]) if parts <= FEW_PARTITIONS and 2 * parts < cores else df


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where a session on one machine names none, as in tests, a temporary folder is set once; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_quellwerk_dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quellwerk-")
        spark._quellwerk_dir = base
    return base


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back, which cuts the lineage.

    The written files survive the loss of any executor; nothing is kept in executor memory. They go when
    the session's driver ends, or by ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/quellwerk-cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _file(spark, path, "deleteOnExit")
    out = spark.read.schema(df.schema).parquet(path)
    out._quellwerk_path = path
    return out


def discard(df: DataFrame) -> None:
    """Removes the files of a frame made by ``cut`` that no later plan reads."""
    path = getattr(df, "_quellwerk_path", None)
    if path:
        _file(df.sparkSession, path, "delete", True)


def _file(spark: SparkSession, path: str, what: str, *args) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    getattr(at.getFileSystem(spark._jsc.hadoopConfiguration()), what)(at, *args)


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: never broadcast, whatever its compressed files' size says."""
    return df.hint("merge")


def sendable(df: DataFrame, bytes_each: int = 0) -> bool:
    """Whether ``df``, at ``ENTRY`` bytes and its own an entry, may be sent to every task."""
    return df.count() * (ENTRY + bytes_each) <= MOST_SENT
