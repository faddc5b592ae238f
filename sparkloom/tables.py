"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Tables of large rows, or of whole texts: a reader holds all cells of a row group at once, so that those are small.
LARGE_ROWS = frozenset(("matrices", "features", "state", "model", "judged", "split"))
SMALL_GROUPS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 8, "parquet.enable.dictionary": "false", "compression": "zstd"}

_local_folder: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session that names none (as in tests) gets a folder of this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="sparkloom-"))
    return f"file://{_local_folder[0]}"


def saved(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write to the shared folder and read back: lineage ends here, and a lost executor costs nothing."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**SMALL_GROUPS if label in LARGE_ROWS else {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete saved tables that no later plan reads."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What a query within has shuffled is deleted when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until they are no column of df, so that working columns touch none of a caller's."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
