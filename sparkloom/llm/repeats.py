"""Removal of long repeated byte strings, by prefix-free parsing.

Of all positions, in all documents, those whose next LENGTH bytes also start elsewhere are found in
corpus order without sorting the corpus:

1. A rolling hash runs over each text. A position is a trigger if its hash is the least of a window
   of WINDOW positions; each window start belongs to the phrase of its window's trigger. Equal strings
   of LENGTH bytes have the same trigger at the same place, so only phrases whose core (the
   LENGTH - WINDOW + 1 bytes from the trigger that all their strings share) is repeated can hold any.
   Most of a corpus goes here, by a count of 64-bit prints.
2. The dictionary has the distinct phrases of these cores, with the context that their strings
   reach. A phrase that is in the parse more than once is repeated with all its strings.
3. Phrases of one core that differ somewhere are put in order twice: by what precedes the trigger,
   read backwards (the suffixes of the dictionary's phrases that end at the trigger), and by what
   follows it (the suffixes of the parse). Common prefixes of neighbours give, for each depth, the
   classes of equal contexts in both arrays; two strings are equal if and only if they start equally far
   before the trigger, in one class of the first and one class of the second. Bytes decide here,
   not prints.
4. Cores of more than HOT differing phrases don't go to one task: the prints of their strings are
   counted one by one, with sums made before the exchange.

Texts that are wholly equal are one class, known by their digests, and only texts with a repeated
core are exchanged. A chance collision of 64-bit prints in steps 1 and 2 must hit core and phrase at once.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import discard, saved, small_batches

LENGTH = 400
#: Positions in which each window has its trigger; at most 256, and LENGTH less the hash's width.
WINDOW = 256
#: Bytes under the rolling hash.
WIDTH = 16
#: Differing phrases of a core that one task orders.
HOT = 16_384

_BLOCK = 1 << 14
_SEEN = 200_000
_BYTE = np.random.default_rng(20240513).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << k, 1 << 64)) for k in range(4)]
_PLACE = "c long, u long, r long, place long"


def _phrases(buffer: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first and last string start) of each phrase of texts that lie in one buffer, one after the other."""
    data = np.frombuffer(buffer, np.uint8)
    starts = np.ones(len(data), bool)
    for end in ends.tolist():
        starts[end - LENGTH + 1 : end] = False
    found = []
    for at in range(0, len(data), _BLOCK):
        h = _BYTE[data[at : at + _BLOCK + WINDOW - 1 + WIDTH]]
        for k in range(4):
            n = 1 << k
            h = h[:-n] * _BASE[k] + h[n:]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h & ~np.uint64(0xFFFF)) | np.arange(len(h), dtype=np.uint64)  # the place breaks ties, and comes out with the least
        n = 1
        while n < WINDOW:
            step = min(n, WINDOW - n)
            h, n = np.minimum(h[:-step], h[step:]), n + step
        trigger, ok = (h & np.uint64(0xFFFF)).astype(np.int64), starts[at : at + _BLOCK]
        n = min(len(trigger), len(ok))
        trigger, ok = trigger[:n], ok[:n]
        new = ok.copy()
        new[1:] &= ~ok[:-1] | (trigger[1:] != trigger[:-1])
        first = np.flatnonzero(new)
        last = np.flatnonzero(ok & np.append(~ok[1:] | new[1:], True))
        found.append((trigger[first] + at, first + at, last + at))
    x, first, last = (np.concatenate(v) for v in zip(*found, strict=True))
    new = np.append(True, (x[1:] != x[:-1]) | (first[1:] != last[:-1] + 1))  # a phrase goes on in the next block
    return x[new], first[new], last[np.append(new[1:], True)]


def _parse(batches):
    """The phrases of each text, as ``place, c, u``: of equal texts in a task, of the first one only."""
    seen = set()
    core, phrase = LENGTH - WINDOW + 1, xxhash.xxh3_64_intdigest
    for batch in batches:
        texts, rows = batch.column("t").cast(pa.binary()), []
        for i, (text, sha) in enumerate(zip(texts.to_pylist(), batch.column("sha").to_pylist(), strict=True)):
            if len(text) >= LENGTH and sha not in seen:
                rows.append((i, text))
                if len(seen) < _SEEN:
                    seen.add(sha)
        sizes = np.zeros(batch.num_rows, np.int64)
        place, c, u = np.empty(0, np.int64), [], []
        if rows:
            buffer = b"".join(t for _, t in rows)
            ends = np.cumsum([len(t) for _, t in rows])
            x, first, last = _phrases(buffer, ends)
            of = np.searchsorted(ends, first, "right")
            sizes[[i for i, _ in rows]] = np.bincount(of, minlength=len(rows))
            hi, lo = x - first, x - last
            place = (x - np.append(0, ends)[of]) << 16 | lo << 8 | hi
            for p, a, b, seed in zip(x.tolist(), first.tolist(), last.tolist(), (place & 0xFFFF).tolist(), strict=True):
                c.append(phrase(buffer[p : p + core]))
                u.append(phrase(buffer[a : b + LENGTH], seed))
        parts = pa.StructArray.from_arrays([pa.array(place), *(pa.array(np.array(v, np.uint64).view(np.int64)) for v in (c, u))], ["place", "c", "u"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), parts)
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("r", "id", "sha", "n")), lists], ["r", "id", "sha", "n", "parts"])


def _contexts(batches):
    """The bytes of phrases that others differ from: those that their strings reach."""
    for batch in batches:
        out = []
        for r, text, wanted in zip(*(batch.column(k).to_pylist() for k in ("r", "t", "wanted")), strict=True):
            text = text.encode() if isinstance(text, str) else text
            for w in wanted or ():
                x, lo, hi = w["place"] >> 16, w["place"] >> 8 & 255, w["place"] & 255
                out.append((w["c"], w["u"], r, w["place"], w["n"], w["m"], text[x - hi : x - lo + LENGTH]))
        columns = zip(*out) if out else [()] * 7
        kinds = [*[pa.int64()] * 6, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], ["c", "u", "r", "place", "n", "m", "s"])


def _in_order(rows: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes within their cores, and how many bytes each shares with the one before it (-1: another core)."""
    keyed = np.ascontiguousarray(np.hstack([core.astype(">i8").view(np.uint8).reshape(-1, 8), rows]))
    order = keyed.view(f"V{keyed.shape[1]}").ravel().argsort()
    there, own = rows[order], core[order]
    other = there[1:] != there[:-1]
    shared = np.where(other.any(axis=1), other.argmax(axis=1), rows.shape[1])
    return order, np.append(-1, np.where(own[1:] == own[:-1], shared, -1))


def _class(order: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """For each row, the number of its class of rows that agree in so many bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < depth)
    return out


def _repeated(core: np.ndarray, place: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """For each phrase, and each number of bytes before its trigger, whether the string from there is in another phrase."""
    hi, lo = place & 255, place >> 8 & 255
    before, after = np.zeros((len(core), WINDOW - 1), np.uint8), np.zeros((len(core), LENGTH), np.uint8)
    for k, s in enumerate(strings):
        data, h = np.frombuffer(s, np.uint8), hi[k]
        before[k, :h] = data[:h][::-1]
        after[k, : len(data) - h] = data[h:]
    dictionary, parse = _in_order(before, core), _in_order(after, core)
    out = np.zeros((len(core), WINDOW), bool)
    for b in range(int(hi.max()) + 1):
        own = np.flatnonzero((lo <= b) & (b <= hi))
        if len(own):
            both = _class(*dictionary, b)[own] * (len(core) + 1) + _class(*parse, LENGTH - b)[own]
            _, which, n = np.unique(both, return_inverse=True, return_counts=True)
            out[own, b] = n[which] > 1
    return out


def _cores(batches):
    """Whole cores of sorted batches, some thousand phrases at a time."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        c = batch.column("c").to_numpy()
        cuts = np.flatnonzero(c[1:] != c[:-1]) + 1
        if held and held[-1].column("c")[-1].as_py() != c[0] and n >= HOT // 2:
            yield pa.Table.from_batches(held)
            held, n = [], 0
        if len(cuts) and n + cuts[-1] >= HOT // 2:
            yield pa.Table.from_batches([*held, batch.slice(0, cuts[-1])])
            held, n, batch = [], 0, batch.slice(cuts[-1])
        held.append(batch)
        n += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _compared(batches):
    """``r, start, end``: what the repeated strings of phrases that are in the parse once cover."""
    for block in _cores(batches):
        core, place, r, n = (block.column(k).to_numpy() for k in ("c", "place", "r", "n"))
        again = _repeated(core, place, block.column("s").to_pylist()) & (n == 1)[:, None]
        edge = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (k, low), (_, high) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        x = place[k] >> 16
        yield pa.RecordBatch.from_arrays([pa.array(r[k]), pa.array(x - high + 1), pa.array(x - low + LENGTH)], ["r", "start", "end"])


def _printed(batches):
    """The prints of all strings of phrases, one list for each."""
    for batch in batches:
        prints = []
        for place, s in zip(batch.column("place").to_pylist(), batch.column("s").to_pylist(), strict=True):
            hi, lo = place & 255, place >> 8 & 255
            prints.append([xxhash.xxh3_64_intdigest(s[hi - b : hi - b + LENGTH]) - 2**63 for b in range(lo, hi + 1)])
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("c", "r", "place", "n")), pa.array(prints, pa.list_(pa.int64()))], ["c", "r", "place", "n", "prints"])


def _edited(batches):
    """Merged spans and the bytes that are left."""
    for batch in batches:
        spans, kept = [], []
        for text, found in zip(batch.column("t").to_pylist(), batch.column("found").to_pylist(), strict=True):
            data, merged = text.encode() if isinstance(text, str) else text, []
            for a, b in sorted((x["start"], x["end"]) for x in found):
                if merged and a <= merged[-1]["end"]:
                    merged[-1]["end"] = max(b, merged[-1]["end"])
                else:
                    merged.append({"start": a, "end": b})
            spans.append(merged)
            kept.append(b"".join(data[a:b] for a, b in zip([0, *(x["end"] for x in merged)], [*(x["start"] for x in merged), len(data)], strict=True)))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("r"), pa.array(spans, kind), pa.array(kept, pa.binary())], ["r", "spans", "kept"])


def _common(hot: DataFrame) -> DataFrame:
    """``r, start, end`` for phrases of very many of one core, by counts of the prints of their strings."""
    prints = hot.mapInArrow(_printed, "c long, r long, place long, n long, prints array<long>")
    b = (F.shiftright("place", 8).bitwiseAND(255) + F.col("pos")).alias("b")
    strings = prints.select("c", "r", "place", "n", F.posexplode("prints").alias("pos", "print")).select("c", "r", "place", "n", b, "print")
    strings, _ = saved(strings, "strings")
    twice = strings.groupBy("c", "b", "print").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    start = F.shiftright("place", 16) - F.col("b")
    return strings.where("n = 1").join(twice, ["c", "b", "print"], "left_semi").select("r", start.alias("start"), (start + LENGTH).alias("end"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, sha256, spans, kept`` for each row.

    spans: the maximal runs of bytes to remove, ``(start, end)`` in order; kept: the bytes that are
    left, null where nothing is removed; sha256: of the whole text. Null texts count as empty; texts
    under LENGTH bytes keep all; texts that are stored more than once (repeated rows too) lose all if
    they have LENGTH bytes. Rows without id, or with the id of others, are rows like any other; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text)
    sha = F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("sha")
    rows = source.select(F.monotonically_increasing_id().alias("r"), "id", sha, F.octet_length("t").cast("long").alias("n"), "t")
    parsed, parsed_path = saved(rows.mapInArrow(_parse, "r long, id long, sha binary, n long, parts array<struct<place:long,c:long,u:long>>"), "parsed")
    twice, twice_path = saved(parsed.select(F.explode("parts.c").alias("c")).groupBy("c").agg(F.count("*").alias("m")).where("m > 1").select("c"), "cores")
    shared, shared_path = saved(parsed.select("r", F.inline("parts")).join(twice, "c").select("c", "u", "r", "place"), "shared")
    phrases = shared.groupBy("c", "u").agg(F.count("*").alias("n"), F.min(F.struct("r", "place")).alias("one"))
    phrases, phrases_path = saved(phrases.select("c", "u", "n", "one.r", "one.place"), "phrases")

    differing = phrases.groupBy("c").agg(F.count("*").alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1").select("c", "m")
    wanted = phrases.join(differing, "c").groupBy("r").agg(F.collect_list(F.struct("c", "u", "place", "n", "m")).alias("wanted"))
    asked = shared.select("r").distinct().join(parsed.select("r", "sha"), "r").join(wanted, "r", "left")
    texts = source.select(sha, "t").groupBy("sha").agg(F.first("t").alias("t"))
    texts, texts_path = saved(asked.join(texts, "sha").select("r", "t", "wanted"), "texts")

    contexts, contexts_path = saved(texts.where("wanted is not null").mapInArrow(_contexts, f"{_PLACE}, n long, m long, s binary"), "contexts")
    few = contexts.where(F.col("m") <= HOT).repartition("c").sortWithinPartitions("c").mapInArrow(_compared, "r long, start long, end long")
    x, lo, hi = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255), F.col("place").bitwiseAND(255)
    whole = shared.join(phrases.where("n > 1").select("c", "u"), ["c", "u"], "left_semi").select("r", (x - hi).alias("start"), (x - lo + LENGTH).alias("end"))
    spans = few.unionByName(whole)
    if contexts.where(F.col("m") > HOT).limit(1).count():
        spans = spans.unionByName(_common(contexts.where(F.col("m") > HOT)))
    copies = parsed.groupBy("sha").agg(F.count("*").alias("copies")).where("copies > 1")
    found = spans.groupBy("r").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    kind = "array<struct<start:long,end:long>>"
    edited, _ = saved(found.join(texts.select("r", "t"), "r").mapInArrow(_edited, f"r long, spans {kind}, kept binary"), "edited")
    base, _ = saved(parsed.select("r", "id", "sha", "n"), "base")
    copies, _ = saved(copies, "copies")
    discard(spark, parsed_path, twice_path, shared_path, phrases_path, texts_path, contexts_path)

    rows = base.join(copies, "sha", "left").join(edited, "r", "left")
    gone = F.col("copies").isNotNull() & (F.col("n") >= LENGTH)
    all_of = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end")))
    spans = F.when(gone, all_of).when(F.col("spans").isNull(), F.array().cast(kind)).otherwise(F.col("spans"))
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_bytes"), F.lower(F.hex("sha")).alias("sha256"), spans.alias("spans"), F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row; cases as in remove_repeats()."""
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    kept = F.when(F.col("kept").isNull(), F.col("sha256")).otherwise(F.sha2("kept", 256))
    return remove_repeats(docs, id_col, text_col).select("doc_id", "n_bytes", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), kept.alias("kept_sha256"))
