"""Token ids in Parquet files: list columns with dictionary pages, delta-encoded metadata, small
row groups and page indexes, so that tokens or metadata of some documents can be read alone.

One range exchange puts the documents in ascending id order over the files. Each file numbers its
tokens from 0; the totals of the files (one number each, read from the metadata columns) give the
place of each file in the whole.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import fresh_path, small_batches
from sparkloom.llm.tokens import Encoder

#: Bytes of text in a file (about); a file's texts are encoded as a stream, so its size doesn't bound memory.
FILE_BYTES = 32 << 20
#: Characters by which texts of one id are ordered over the files.
TIE_CHARS = 32
WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(8 << 20),
    "parquet.page.size": str(128 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#first": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
SCHEMA = "doc_id long, file int, first long, n_tokens int, ids array<int>"


def _encoded(batches, path: str, spaced: bool, end_id: int):
    encoder, first, end = Encoder.of(path, spaced), 0, np.array([end_id], "<u4").tobytes()
    file = TaskContext.get().partitionId()
    for doc_ids, texts in encoder.groups(batches):
        ids = [x + end for x in texts]
        n = np.array([len(x) // 4 for x in ids], np.int64)
        starts = first + np.cumsum(n) - n
        first += int(n.sum())
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        yield pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(np.full(len(n), file, np.int32)), pa.array(starts), pa.array(n.astype(np.int32)), lists],
            ["doc_id", "file", "first", "n_tokens", "ids"],
        )


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaced: bool = False, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts (null: empty), append end_id to each, write them by ascending id.

    Null ids come first; rows that share an id are ordered by the first TIE_CHARS characters of
    their texts, and beyond that stand in any order (a place in the input divides them, so that many
    copies of a row are not one file); an empty table gives files without rows. Other columns are
    ignored.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    size = source.agg(F.sum(F.octet_length("t")), F.count("*")).first()
    files = -(-((size[0] or 0) + 8 * size[1]) // FILE_BYTES) or 1
    placed = source.select("doc_id", "t", F.left(F.col("t"), F.lit(TIE_CHARS)).alias("head"), F.monotonically_increasing_id().alias("place"))
    ordered = placed.repartitionByRange(files, "doc_id", "head", "place").select("doc_id", "t").sortWithinPartitions("doc_id", "t")
    made = ordered.mapInArrow(lambda it: _encoded(it, tokenizer, spaced, end_id), SCHEMA)
    made.write.options(**WRITER).parquet(path)


def _checked(batches):
    for batch in batches:
        lists = batch.column(3)
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
        n = np.diff(offsets).astype(np.int64)
        crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(n), pa.array(crcs, pa.int64())], ["doc_id", "file", "first", "n_tokens", "ids_crc32"])


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """``file, before``: the tokens of all files before each; reads two metadata columns."""
    totals = spark.read.schema(SCHEMA).parquet(path).groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    before = [0, *accumulate(r["n"] for r in totals)]
    return spark.createDataFrame([(r["file"], b) for r, b in zip(totals, before)], "file int, before long")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` from the metadata columns alone."""
    meta = spark.read.schema(SCHEMA).parquet(path).select("doc_id", "file", "first", "n_tokens")
    return meta.join(file_starts(spark, path), "file").select("doc_id", (F.col("before") + F.col("first")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``, count and checksum made from the ids as read."""
    small_batches(spark)
    rows = spark.read.schema(SCHEMA).parquet(path).select("doc_id", "file", "first", "ids")
    rows = rows.mapInArrow(_checked, "doc_id long, file int, first long, n_tokens long, ids_crc32 long")
    return rows.join(file_starts(spark, path), "file").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool = False) -> DataFrame:
    """Write the token files to the shared folder, then read every document back from them."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id, spaced)
    return read_tokens(docs.sparkSession, path)
