"""Histogram sort: shards of near-equal bytes from one exchange.

Documents are sorted by the hash of their text, so that equal texts stand together. Candidate
boundaries (probes) are laid over the key range; each pass counts the exact bytes and rows below
every probe, over all partitions at once, and lays new probes between the two that enclose each
wanted boundary, until it is met within tolerance. Then the rows are exchanged once.

Texts of which a group, or a single one, holds more than half the tolerance would be in the way of a
boundary; there are at most 2 * shards / tolerance of them. They are dealt whole to the emptiest shards, largest
first, and the boundaries of the rest fill up each shard. Only a group that is larger than a shard is
divided: its rows have keys of their own.

The driver holds the boundaries between shards, their probes and the frequent texts, whatever the
size of the corpus. Slots are counted in chunks of bounded rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import saved

#: Allowed difference between the sizes of two shards, as half a share of a shard: a boundary is within half of it.
TOLERANCE = 0.002
#: Rows (about) of a chunk that is numbered by one task.
CHUNK_ROWS = 250_000
PROBES, MOST_PROBES, LOWEST = 33, 2048, -(2**63)


def _counted(batches, probes: np.ndarray):
    """Bytes and rows in each gap between probes, of one partition."""
    size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for batch in batches:
        at = np.searchsorted(probes, batch.column(0).to_numpy(), "right")
        np.add.at(size, at, batch.column(1).to_numpy())
        rows += np.bincount(at, minlength=len(rows))
    has = np.flatnonzero(rows)
    yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(size[has]), pa.array(rows[has])], ["gap", "size", "n"])


def _below(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe."""
    counted = keys.mapInArrow(partial(_counted, probes=probes), "gap long, size long, n long")
    size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for r in counted.groupBy("gap").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect():
        size[r["gap"]], rows[r["gap"]] = r["size"], r["n"]
    return np.cumsum(size)[:-1], np.cumsum(rows)[:-1]


def splitters(keys: DataFrame, targets: list[int], slack: float, total: tuple[int, int]) -> list[int]:
    """For each target (bytes): the key of the nearest boundary found.

    keys has a long key and a long size; total is its bytes and rows. A boundary is refined until
    it is within slack of its target, or until all rows between it and the next one have one key.
    """
    lo = [(LOWEST, 0, 0)] * len(targets)
    hi = [(2**63 - 1, *total)] * len(targets)
    done = [False] * len(targets)
    while open_ := [i for i, x in enumerate(done) if not x]:
        asked = set()
        each = max(PROBES, MOST_PROBES // len(open_))
        for i in open_:
            a, b = lo[i][0], hi[i][0]
            asked.update(a + (b - a) * k // (each + 1) for k in range(1, each + 1))
        probes = np.array(sorted(x for x in asked if x > LOWEST), np.int64)
        size, rows = _below(keys, probes)
        for i in open_:
            k = int(np.searchsorted(size, targets[i], "right"))
            if k and probes[k - 1] >= lo[i][0]:
                lo[i] = (int(probes[k - 1]), int(size[k - 1]), int(rows[k - 1]))
            if k < len(probes) and probes[k] <= hi[i][0]:
                hi[i] = (int(probes[k]), int(size[k]), int(rows[k]))
            off = min(targets[i] - lo[i][1], hi[i][1] - targets[i])
            done[i] = off <= slack or hi[i][2] - lo[i][2] <= 1 or hi[i][0] - lo[i][0] <= 1
    return [x[0] if target - x[1] <= y[1] - target else y[0] for x, y, target in zip(lo, hi, targets, strict=True)]


@dataclass
class Plan:
    """The shards: boundaries of keys, the shards of frequent texts, the divided texts, chunks of a shard."""

    shards: int
    cuts: list[int]
    frequent: dict[int, int]
    divided: list[int]
    chunks: int

    def key(self):
        """A row's place in the sort: its text's hash, or, if the text is divided, its own."""
        return F.when(F.col("h").isin(self.divided), F.xxhash64("h", "o", "salt")).otherwise(F.col("h")) if self.divided else F.col("h")

    def placed(self, rows: DataFrame) -> DataFrame:
        """Adds shard and chunk to rows."""
        cuts = F.array(*[F.lit(c).cast("long") for c in self.cuts]) if self.cuts else F.array().cast("array<long>")
        key = self.key()
        shard = F.size(F.filter(cuts, lambda c: c <= key)).cast("int")
        chunk = F.pmod(F.xxhash64("salt"), F.lit(self.chunks)).cast("int").alias("chunk")
        if not self.frequent:
            return rows.select("*", shard.alias("shard"), chunk)
        known = rows.sparkSession.createDataFrame(list(self.frequent.items()), "h long, own int")
        return rows.join(F.broadcast(known), "h", "left").select(*rows.columns, F.coalesce("own", shard).alias("shard"), chunk)


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = F.col(f"`{id_col}`").cast("long")
    return docs.select(
        *more, own.alias("id"), F.xxhash64(text).alias("h"), F.coalesce(own, F.lit(LOWEST)).alias("o"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), F.monotonically_increasing_id().alias("salt"),
    )


def plan_shards(rows: DataFrame, shards: int, tolerance: float) -> Plan:
    """How to deal rows (``h, o, size, salt``) into shards of near-equal bytes."""
    total, n = (x or 0 for x in rows.agg(F.sum("size"), F.count("*")).first())
    ideal = total / shards
    groups = rows.groupBy("h").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    large = groups.where(F.col("size") > tolerance * ideal / 2).collect()
    loads, frequent = [0] * shards, {}
    for g in sorted(large, key=lambda g: (-g["size"], g["h"])):
        if g["size"] <= ideal:
            k = loads.index(min(loads))
            frequent[g["h"]], loads[k] = k, loads[k] + g["size"]
    plan = Plan(shards, [], frequent, [g["h"] for g in large if g["size"] > ideal], -(-n // (shards * CHUNK_ROWS)) or 1)
    rest, rest_rows = total - sum(loads), n - sum(g["n"] for g in large if g["h"] in frequent)
    keys = rows.select(plan.key().alias("key"), "size", "h")
    if frequent:
        known = rows.sparkSession.createDataFrame([(h,) for h in frequent], "h long")
        keys = keys.join(F.broadcast(known), "h", "left_anti")
    if rest_rows:
        plan.cuts = splitters(keys.select("key", "size"), _targets(loads, rest), ideal * tolerance / 2, (rest, rest_rows))
    return plan


def _targets(loads: list[int], rest: int) -> list[int]:
    """Where the boundaries of the rest should be, so that it fills shards of these loads to one level."""
    level, below = 0.0, sorted(loads)
    for k in range(1, len(below) + 1):
        level = (rest + sum(below[:k])) / k
        if k == len(below) or level <= below[k]:
            break
    need = np.maximum(level - np.array(loads, float), 0)
    return [int(x) for x in np.cumsum(need)[:-1]]


def _numbered(placed: DataFrame) -> DataFrame:
    """Adds slot: gapless in each shard, by chunk, then by hash, id and place in the input."""
    counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = counts.select(F.col("shard").alias("s"), F.col("chunk").alias("c"), (F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("h", "o", "salt")) - 1
    rows = placed.withColumn("rank", own).join(before, (F.col("shard") == F.col("s")) & (F.col("chunk") == F.col("c")))
    return rows.withColumn("slot", (F.col("before") + F.col("rank")).cast("long"))


def shard_by_bytes(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row.

    A size is the text's UTF-8 bytes (null: none) and 1. Equal texts (null is the empty one) are in
    one shard, but for a group larger than a shard, which is divided. Slots number a shard's rows
    from 0. Repeated rows are stored as often; null ids come before others of their text; other
    columns are ignored; an empty table gives an empty result.
    """
    rows, _ = saved(_keyed(docs, id_col, text_col), "keys")
    plan = plan_shards(rows, shards, tolerance)
    return _numbered(plan.placed(rows)).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text", shard_col: str = "shard") -> None:
    """The rows of docs with all their columns, in one folder for each shard, in the order of slots within files.

    Folders are named by shard_col, which must not be a column of docs. Rows are exchanged once, by
    shard and chunk; cases as in shard_by_bytes().
    """
    names = docs.columns
    if shard_col in names:
        raise ValueError(f"the documents have a column {shard_col}; name another shard_col")
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row")
    plan = plan_shards(saved(_keyed(docs, id_col, text_col), "keys")[0], shards, tolerance)
    rows = plan.placed(_keyed(docs, id_col, text_col, row)).repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", "h", "o", "salt")
    rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)], F.col("shard").alias(shard_col)).write.partitionBy(shard_col).parquet(path)
