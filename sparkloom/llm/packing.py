"""Best-two-fit packing of documents into sequences of bounded length.

A bin is filled greedily with the longest pieces that fit; then its smallest piece makes way for
the two unpacked pieces that together fill the widened gap most tightly, if they fill it better.
Only lengths matter for that, so the plan is made from the histogram of lengths (at most
``capacity`` numbers whatever the corpus): a bin's pattern is repeated while its lengths last,
which is what packing one bin after the other would do. Pieces then find their places by their
rank among the pieces of equal length, counted in two steps in chunks of bounded rows. Pieces of
capacity, the most of a long document, fill a sequence each and need no rank.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import saved, small_batches
from sparkloom.llm.tokens import Encoder

#: Rows (about) of one length that are ranked by one task.
CHUNK_ROWS = 250_000


def _pieces(batches, path: str, spaced: bool, end_id: int, capacity: int):
    encoder, end = Encoder.of(path, spaced), np.array([end_id], "<u4").tobytes()
    for doc_ids, texts in encoder.groups(batches):
        rows = []
        for doc_id, ids in zip(doc_ids.to_pylist(), texts, strict=True):
            ids += end
            n = len(ids) // 4
            cut = (n - 1) % capacity + 1
            for k, (a, b) in enumerate(zip([0, *range(cut, n, capacity)], range(cut, n + 1, capacity), strict=True)):
                rows.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
        columns = zip(*rows) if rows else [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(how many bins, their piece lengths in order), for a histogram of lengths up to capacity."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[int, list[int]]] = []
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return out
        now, items, gap = left.copy(), [], capacity
        while gap and len(fit := there[: np.searchsorted(there, gap, "right")]):
            fit = fit[now[fit] > 0]
            if not len(fit):
                break
            items.append(int(fit[-1]))
            now[fit[-1]] -= 1
            gap -= int(fit[-1])
        if gap:
            smallest = min(items)
            now[smallest] += 1
            best = _two(np.flatnonzero(now), now, gap + smallest)
            if sum(best) > smallest:
                items.remove(smallest)
                items += best
        need = Counter(items)
        times = int(min(left[k] // v for k, v in need.items()))
        for k, v in need.items():
            left[k] -= times * v
        out.append((times, items))


def _two(there: np.ndarray, left: np.ndarray, room: int) -> list[int]:
    """The two available lengths with the largest sum up to room."""
    partner = np.searchsorted(there, room - there, "right") - 1
    ok = partner >= 0
    a, b = there[ok], there[partner[ok]]
    alone = (a == b) & (left[a] < 2)
    if alone.any():  # the same piece can't be taken twice; take the next shorter one
        lower = partner[ok] - 1
        b = np.where(alone, np.where(lower >= 0, there[np.maximum(lower, 0)], 0), b)
    total = np.where(b > 0, a + b, -1)
    if not len(total) or total.max() <= 0:
        return []
    k = int(total.argmax())
    return [int(a[k]), int(b[k])]


def _rules(plan: list[tuple[int, list[int]]]) -> dict[int, tuple]:
    """For each length: the first rank of each of its runs, and the run's first bin and places."""
    rules: dict[int, list] = {}
    ranks: Counter = Counter()
    base = 0
    for times, items in plan:
        places: dict[int, list[int]] = {}
        at = 0
        for length in items:
            places.setdefault(length, []).append(at)
            at += length
        for length, where in places.items():
            rules.setdefault(length, []).append((ranks[length], base, where))
            ranks[length] += times * len(where)
        base += times
    return {k: (np.array([x[0] for x in v], np.int64), v) for k, v in rules.items()}


def _placed(batches, rules: dict):
    for batch in batches:
        length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
        bins, offsets = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for i, (n, r) in enumerate(zip(length.tolist(), rank.tolist(), strict=True)):
            firsts, runs = rules[n]
            first, base, where = runs[int(np.searchsorted(firsts, r, "right")) - 1]
            q = r - first
            bins[i], offsets[i] = base + q // len(where), where[q % len(where)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(bins), pa.array(offsets)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, spaced: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: its place in its document and in its sequence, and its ids' checksum.

    Null and empty texts are the end id alone. Documents longer than capacity are cut from their
    end, so that only the first piece may be shorter. Repeated rows and null ids are packed like
    others; other columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    made = source.mapInArrow(partial(_pieces, path=tokenizer, spaced=spaced, end_id=end_id, capacity=capacity), schema)
    pieces, _ = saved(made.withColumn("place", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_bins({k: n for k, n in counts.items() if k < capacity}, capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    full = pieces.where(F.col("length") == capacity).select(*columns, (F.col("place") + sum(times for times, _ in plan)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    chunks = F.element_at(F.array(*[F.lit(-(-counts.get(k, 0) // CHUNK_ROWS) or 1) for k in range(1, capacity + 1)]), F.col("length").cast("int"))
    dealt = pieces.where(F.col("length") < capacity).withColumn("chunk", F.pmod(F.xxhash64("place"), chunks))
    groups = dealt.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = groups.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n"))
    own = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("own", F.row_number().over(own) - 1).join(before.drop("n"), ["length", "chunk"])
    ranked = ranked.select(*columns, (F.col("own") + F.col("before")).cast("long").alias("rank"))
    return ranked.mapInArrow(partial(_placed, rules=_rules(plan)), f"{schema}, sequence_id long, offset long").unionAll(full)
