"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the benchmark's distinct windows of ten words. Words are numbered; a hashed table of
two-word blocks tells how far a search may jump when a block ends at some place of no pattern; where
it may not jump, the hash of the block selects a bucket of patterns, which are sorted, so that a
binary search compares the few that may be equal word for word. Items of fewer words are patterns of
their own lengths and have tables of their own, so that they don't shorten the jumps of the long ones.

Tables are numpy arrays and bytes, about 60 bytes for each window beside the distinct words, and are
broadcast: a pass takes PASS_BYTES of benchmark text, which bounds them; a larger benchmark is searched
for in several passes.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import saved, small_batches

WINDOW, BLOCK = 10, 2
#: Bytes of benchmark text searched for at once; more are searched in several passes.
PASS_BYTES = 4 << 20
#: Multipliers of the hash of a block's first and last word.
_FIRST, _LAST = 0x9E3779B1, 0x85EBCA77

#: Digits, letters (lower-cased) and all bytes from 0x80 stay; everything else separates words.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | str | None) -> list[bytes]:
    if not text:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_WORDS).split()


def _table(words: np.ndarray, items: np.ndarray) -> dict:
    """Shift table, buckets and items of the patterns in the rows of words, which have one length."""
    length = words.shape[1]
    block = min(BLOCK, length)
    far = length - block + 1
    bits = max(8, int(2 * far * len(words)).bit_length())
    mask = (1 << bits) - 1
    hashed = lambda end: (words[:, end - block].astype(np.int64) * _FIRST + words[:, end - 1].astype(np.int64) * _LAST) & mask
    shift = np.full(mask + 1, min(far, 255), np.uint8)
    for end in range(block, length + 1):
        np.minimum.at(shift, hashed(end), min(length - end, 255))
    rows = np.column_stack([hashed(length), words, items])
    rows = np.unique(rows, axis=0)  # by bucket, words, item
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)
    firsts = np.flatnonzero(new)
    return {
        "length": length, "block": block, "far": far, "mask": mask, "shift": shift.tobytes(),
        "starts": np.searchsorted(rows[firsts, 0], np.arange(mask + 2)).astype(np.int32),
        "patterns": rows[firsts, 1:-1].astype(">i4").tobytes(), "item_starts": np.append(firsts, len(rows)).astype(np.int32), "items": rows[:, -1].astype(np.int32),
    }


def build(items: list[tuple[str, str | None]]) -> dict:
    """Word numbers, item names and a table for each length of pattern, for (item, text) pairs; a text without words gives no pattern."""
    numbers: dict[bytes, int] = {}
    names = sorted({item for item, _ in items})
    at = {name: i for i, name in enumerate(names)}
    windows: dict[int, list[np.ndarray]] = {}
    owners: dict[int, list[np.ndarray]] = {}
    for item, text in items:
        words = words_of(text)
        if not words:
            continue
        length = min(WINDOW, len(words))
        own = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.int32)
        cut = np.lib.stride_tricks.sliding_window_view(own, length)
        windows.setdefault(length, []).append(cut)
        owners.setdefault(length, []).append(np.full(len(cut), at[item], np.int32))
    tables = [_table(np.concatenate(windows[n]), np.concatenate(owners[n])) for n in sorted(windows)]
    return {"numbers": numbers, "names": names, "tables": tables}


def search(words: list[bytes], numbers: dict[bytes, int], table: dict):
    """Yields (start, item numbers) for each occurrence of a pattern."""
    m, b, n, far, mask, shift, number = table["length"], table["block"], len(words), table["far"], table["mask"], table["shift"], numbers.get
    starts, patterns = table["starts"], table["patterns"]
    end = m
    while end <= n:
        last = number(words[end - 1], 0)
        if not last:  # a word of no pattern
            end += m
            continue
        first = number(words[end - b], 0)
        if not first:
            end += far
            continue
        h = (first * _FIRST + last * _LAST) & mask
        jump = shift[h]
        if jump:
            end += jump
            continue
        lo, hi = int(starts[h]), int(starts[h + 1])
        if lo < hi:
            asked = np.array([number(w, 0) for w in words[end - m : end]], ">i4").tobytes()
            size = 4 * m
            while lo < hi:
                mid = (lo + hi) // 2
                found = patterns[mid * size : mid * size + size]
                if found == asked:
                    yield end - m, table["items"][table["item_starts"][mid] : table["item_starts"][mid + 1]].tolist()
                    break
                if found < asked:
                    lo = mid + 1
                else:
                    hi = mid
        end += 1


def _scan(batches, made):
    """Adds this pass's hits (flat pairs of start and end) and items to those of earlier passes; made: build(), broadcast."""
    numbers, names, tables = (made.value[x] for x in ("numbers", "names", "tables"))
    for batch in batches:
        hits, found = [], []
        for text, spans, items in zip(batch.column("_t").cast(pa.binary()).to_pylist(), batch.column("_hits").to_pylist(), batch.column("_items").to_pylist(), strict=True):
            words, here = words_of(text), set(items)
            for t in tables:
                for start, got in search(words, numbers, t):
                    here.update(names[i] for i in got)
                    if spans and spans[-2] <= start <= spans[-1]:
                        spans[-1] = max(spans[-1], start + t["length"])
                    else:
                        spans += (start, start + t["length"])
            hits.append(spans), found.append(sorted(here))
        columns = {**{n: batch.column(n) for n in batch.schema.names}, "_hits": pa.array(hits, pa.list_(pa.int64())), "_items": pa.array(found, pa.list_(pa.string()))}
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _digest(batches):
    for batch in batches:
        n_words, n_hit, n_items, sha = [], [], [], []
        for text, spans, items in zip(batch.column("_t").cast(pa.binary()).to_pylist(), batch.column("_hits").to_pylist(), batch.column("_items").to_pylist(), strict=True):
            n_words.append(len(words_of(text)))
            covered, upto = 0, 0
            for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
                covered += max(0, b - max(a, upto))
                upto = max(upto, b)
            n_hit.append(covered)
            n_items.append(len(items))
            sha.append(hashlib.sha256(",".join(items).encode()).hexdigest())
        long = partial(pa.array, type=pa.int64())
        made = [batch.column("_id"), long(n_words), long(n_hit), long(n_items), pa.array(sha, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_())]
        yield pa.RecordBatch.from_arrays(made, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _passes(benchmark: DataFrame, item_col: str, text_col: str):
    """Yields (number of passes, build() of one pass's items); its size is bounded, and there is one unless the benchmark is large."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("t"))
    size = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    blocks = -(-size // PASS_BYTES) or 1
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == k)
        yield blocks, build([(r["item"] if r["item"] is not None else "", r["t"]) for r in part.collect()])


def _scanned(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Adds ``_hits`` (spans of words, in pairs of start and end) and ``_items`` to rows that have a text ``_t``."""
    small_batches(rows.sparkSession)
    out = rows.withColumns({"_hits": F.array().cast("array<long>"), "_items": F.array().cast("array<string>")})
    for blocks, made in _passes(benchmark, "item_id", "text"):
        made = rows.sparkSession.sparkContext.broadcast(made)
        out = out.mapInArrow(partial(_scan, made=made), out.schema)
        if blocks > 1:  # one pass's tables in memory at a time
            out, _ = saved(out, "pass")
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row of docs.

    Null and empty texts, of documents as of items, have no words; equal items count each, rows of
    one item_id count once, a null item_id counts as the empty string. Repeated documents give
    repeated rows. Without items nothing is contaminated. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    return _scanned(rows, benchmark).mapInArrow(_digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark window, with all their columns, whole.

    One pass over the texts; rows aren't joined by id, so repeated and null ids do no harm.
    """
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    out = _scanned(docs.select(F.col("text").alias("_t"), row.alias("_row")), benchmark)
    kept = out.where(F.size("_hits") == 0)
    return kept.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)])
