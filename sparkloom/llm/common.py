"""Shared pieces of the training-data operators: tables, the shared folder, saved tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes (about) that one Arrow batch may hold.
ARROW_ROWS, ARROW_BYTES = 256, 4 << 20

_local_folder: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Arrow batches that hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local session that names none (as in tests) gets a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="sparkloom-"))
    return f"file://{_local_folder[0]}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write to the shared folder and read back: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete saved tables that no later plan reads."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def within(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; decides between broadcast and shuffle."""
    return df.agg(F.count("*")).first()[0] <= rows


def listed(df: DataFrame, rows: int) -> DataFrame:
    """The small side of a join with texts: broadcast up to so many rows; beyond, both sides are exchanged, and texts pass by hash tables of this side, unsorted."""
    return F.broadcast(df) if within(df, rows) else df.hint("shuffle_hash")
