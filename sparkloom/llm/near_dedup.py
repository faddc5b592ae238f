"""MinHash near-duplicates with exact confirmation.

1. Each text becomes its set of distinct five-word shingles (64-bit prints), K universal hash
   minima, B band keys and a short signature. Equal sets collapse to one class at once.
2. Classes that share a band key are candidates. Each bucket links its members to its centre, the
   class with the most bucket mates (a star), never to one another; signatures discard unlikely
   links, and the shingle sets, made again from the texts of the classes still in question,
   confirm the rest exactly.
3. Large-star and small-star give components. Members of one bucket that are still in different
   components after that, and were not compared, are then compared in blocks: signatures tell who
   has a likely partner, and the sets of these confirm links until the block is connected. Only
   links that join two components leave a block, so that a link which is hidden behind a
   dissimilar centre isn't lost and no block gives all its pairs.

With R rows a band and B bands, a pair of similarity s meets in no bucket with probability
(1 - s^R)^B: 5e-6 at 0.75 for 4 and 32.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import discard, listed, saved, small_batches, within
from sparkloom.llm.components import connected_components

WORDS = 5
ROWS, BANDS = 4, 32
#: A signature keeps eight bits of each minimum; pairs under this estimate are not confirmed.
#: At 0.75 and 128 minima the estimate has a standard deviation of 0.038.
LEAST_ESTIMATE = 0.55
#: Ids that may be broadcast (8 bytes each, or 16 with a text's print); more go by a shuffled join.
BROADCAST_IDS = 2_000_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALTS = np.random.default_rng(20240229).integers(0, 2**63, (2, ROWS * BANDS), dtype=np.uint64)
_A, _B = (_SALTS[0] * np.uint64(2) + np.uint64(1))[:, None], _SALTS[1][:, None]
_CACHE = 400_000
_CHUNK = 2048
#: Members of a bucket that are compared with one another in one task.
BLOCK = 512


class _Prints(dict):
    """Word to the eight bytes of its 64-bit print."""

    def __missing__(self, word: bytes) -> bytes:
        made = xxhash.xxh3_64_digest(word)
        if len(self) < _CACHE and len(word) <= 64:
            self[word] = made
        return made


def _shingles(text: bytes | None, prints: _Prints) -> np.ndarray:
    """The sorted distinct shingle prints of a text; a text of fewer words is one shingle."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.frombuffer(b"".join([prints[x] for x in words]), ">u8").astype(np.uint64)
    n = min(WORDS, len(w))
    s = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        s = s * _MIX + w[i : i + len(s)]
    s ^= s >> np.uint64(29)
    return np.unique(s * _MIX)


def _minima(u: np.ndarray) -> np.ndarray:
    out = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(u), _CHUNK):
        np.minimum(out, (_A * u[i : i + _CHUNK] + _B).min(axis=1), out=out)
    return out


def _sign(batches):
    prints = _Prints()
    for batch in batches:
        n, keys, bands, sigs = [], [], [], []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            u = _shingles(text, prints)
            n.append(len(u))
            if not len(u):
                keys.append(None), bands.append(None), sigs.append(None)
                continue
            m = _minima(u)
            keys.append(int(np.uint64(xxhash.xxh3_64_intdigest(u.tobytes())).astype(np.int64)))
            band = np.arange(1, BANDS + 1, dtype=np.uint64)
            for row in (m >> np.uint64(16)).reshape(BANDS, ROWS).T:
                band = (band ^ (band >> np.uint64(31))) * _MIX + row
            bands.append(((band ^ (band >> np.uint64(32))) * _MIX).astype(np.int64))
            sigs.append(((m >> np.uint64(8)) & np.uint64(255)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary()), batch.column(2)],
            ["id", "n", "k", "bands", "sig", "t"],
        )


def _sets(batches):
    prints = _Prints()
    for batch in batches:
        keys, sets = [], []
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            u = _shingles(text, prints)
            keys.append(int(np.uint64(xxhash.xxh3_64_intdigest(u.tobytes())).astype(np.int64)))
            sets.append(u.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["k", "s"])


def _alike(batches):
    """Of pairs with two signatures, those whose estimate is high enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, ROWS * BANDS) for c in ("sa", "sb"))
        same = (x == y).mean(axis=1)
        keep = (same - 1 / 256) / (1 - 1 / 256) >= LEAST_ESTIMATE
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _near(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for two sorted sets."""
    short, long = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(short) < percent * len(long):
        return False
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    both = int((long[at] == short).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _linked(batches, percent: int):
    """Of pairs with two full sets, those with 100 * intersection >= percent * union."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
            keep.append(_near(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, k, bands, sig, t`` for each row: set size, print of the set, band keys, signature, print of the text.

    A null text or one without words has n = 0 and null in the rest.
    """
    small_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("t"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"))
    return source.mapInArrow(_sign, "id long, n long, k long, bands array<long>, sig binary, t long")


def _sets_of(classes: DataFrame, asked: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``k, s`` and where they are saved: the full sets of the classes asked for, made again from a text of each."""
    ids = classes.join(asked, "k", "left_semi").select("first").distinct()
    ids = F.broadcast(ids) if within(ids, BROADCAST_IDS) else ids
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("first"), F.col(text_col).alias("t")).where("t is not null")
    sets = texts.join(ids, "first", "left_semi").select("t").mapInArrow(_sets, "k long, s binary")
    return saved(sets.groupBy("k").agg(F.first("s").alias("s")), "sets")


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Of the candidate pairs (a, b) of classes, the links, saved; signatures first, then full sets."""
    sigs = classes.select("k", "sig")
    likely = (
        pairs.join(sigs.withColumnsRenamed({"k": "a", "sig": "sa"}), "a")
        .join(sigs.withColumnsRenamed({"k": "b", "sig": "sb"}), "b")
        .select("a", "b", "sa", "sb")
        .mapInArrow(_alike, "a long, b long")
    )
    likely, likely_path = saved(likely, "likely")
    sets, sets_path = _sets_of(classes, likely.select(F.col("a").alias("k")).unionAll(likely.select(F.col("b").alias("k"))).distinct(), docs, id_col, text_col)
    full = likely.join(sets.withColumnsRenamed({"k": "a", "s": "sa"}), "a").join(sets.withColumnsRenamed({"k": "b", "s": "sb"}), "b")
    links, _ = saved(full.select("a", "b", "sa", "sb").mapInArrow(lambda it: _linked(it, percent), "a long, b long"), "links")
    discard(classes.sparkSession, likely_path, sets_path)
    return links


def _blocks(batches):
    """Runs of equal (h, i, j) in sorted batches, each as one table."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in ("h", "i", "j")]
        new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in keys], axis=0)) + 1
        for a, b in zip([0, *new], [*new, batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            if held and any(held[-1].column(c)[-1] != part.column(c)[0] for c in ("h", "i", "j")):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _likely_rows(block: pa.Table):
    """Signatures, and for each row the later rows of another component (and, across two parts, of the other part) that look alike."""
    sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), np.uint8).reshape(-1, ROWS * BANDS)
    root, own = block.column("root").to_numpy(), block.column("own").to_numpy()
    apart = block.column("i")[0] != block.column("j")[0]
    for x in range(len(sig) - 1):
        ok = root[x + 1 :] != root[x]
        if apart:
            ok &= own[x + 1 :] != own[x]
        y = np.flatnonzero(ok) + x + 1
        if len(y):
            same = (sig[y] == sig[x]).mean(axis=1)
            y = y[(same - 1 / 256) / (1 - 1 / 256) >= LEAST_ESTIMATE]
        yield x, y


def _partnered(batches):
    """The rows that have a likely partner in their block which they meet in no earlier bucket."""
    for block in _blocks(batches):
        h = block.column("h")[0].as_py()
        bands = np.array(block.column("bands").to_pylist(), np.int64)
        keep = np.zeros(len(bands), bool)
        for x, y in _likely_rows(block):
            if len(y):
                first = (bands[y] == bands[x]).argmax(axis=1)
                y = y[bands[x][first] == h]
                keep[y] = True
                keep[x] |= len(y) > 0
        if keep.any():
            yield from block.select(["h", "i", "j", "own", "k", "root", "sig"]).filter(pa.array(keep)).to_batches()


def _joining(batches, percent: int):
    """Confirmed links of each block that join two of its components."""
    for block in _blocks(batches):
        k, roots = block.column("k").to_pylist(), block.column("root").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in block.column("s").to_pylist()]
        up = {r: r for r in roots}

        def top(r, up=up):
            while up[r] != r:
                up[r] = up[up[r]]
                r = up[r]
            return r

        a, b = [], []
        for x, y in _likely_rows(block):
            for z in y.tolist():
                if top(roots[x]) != top(roots[z]) and _near(sets[x], sets[z], percent):
                    up[top(roots[x])] = top(roots[z])
                    a.append(k[x]), b.append(k[z])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _between_components(rows: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Links between members of one bucket that are in different components, saved; rows: ``h, k, m, root``.

    A bucket of more than BLOCK members is dealt into parts, and every two parts meet in one block.
    """
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.col("k"), parts.cast("long")).cast("int")
    dealt = rows.join(classes.select("k", "sig", "bands"), "k").withColumn("own", own)
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("with"))
    dealt = dealt.select("h", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "k", "root", "sig", "bands")
    sort = lambda d: d.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "k")
    kept, kept_path = saved(sort(dealt).mapInArrow(_partnered, "h long, i int, j int, own int, k long, root long, sig binary"), "partnered")
    sets, sets_path = _sets_of(classes, kept.select("k").distinct(), docs, id_col, text_col)
    full = sort(kept.join(sets, "k").select("h", "i", "j", "own", "k", "root", "sig", "s"))
    more, _ = saved(full.mapInArrow(lambda it: _joining(it, percent), "a long, b long"), "more")
    discard(classes.sparkSession, kept_path, sets_path)
    return more


def _grouped(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """``id, t, n, root, component``: for each row its component's root and smallest id; null for texts without words."""
    signed, _ = saved(sign(docs, id_col, text_col), "signed")
    classes = signed.where("n > 0").groupBy("k").agg(
        F.min("id").alias("least"), F.min(F.coalesce("id", F.lit(-(2**63)))).alias("first"), F.first("bands").alias("bands"), F.first("sig").alias("sig")
    )
    classes, _ = saved(classes, "classes")
    members = classes.select("k", F.explode("bands").alias("h"))
    buckets, buckets_path = saved(members.groupBy("h").agg(F.min("k").alias("c"), F.count("*").alias("m")).where("m > 1"), "buckets")
    held, held_path = saved(members.join(buckets, "h").select("h", "k", "m"), "held")
    mates = held.groupBy("k").agg(F.sum("m").alias("mates"))
    centres = held.join(mates, "k").groupBy("h").agg(F.max(F.struct("mates", "k")).alias("c")).select("h", "c.k")
    stars = held.join(centres.withColumnRenamed("k", "c"), "h").where("k <> c").select(F.col("k").alias("a"), F.col("c").alias("b")).distinct()
    links = _confirm(stars, classes, docs, id_col, text_col, percent)
    found, _ = saved(connected_components(links), "found")

    others = held.where("m > 2").join(found.withColumnRenamed("node", "k"), "k", "left").select("h", "k", "m", F.coalesce("root", "k").alias("root"))
    others, others_path = saved(others, "others")
    split = others.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("h")
    more = _between_components(others.join(split, "h", "left_semi"), classes, docs, id_col, text_col, percent)
    discard(docs.sparkSession, buckets_path, held_path, others_path)
    if more.limit(1).count():
        known = found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        found = connected_components(known.unionAll(more))

    named = classes.select("k", "least").join(found.withColumnRenamed("node", "k"), "k", "left").select("k", "least", F.coalesce("root", "k").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(ids, "root").select("k", "root", "component")
    return signed.select("id", "t", "n", "k").join(named, "k", "left").select("id", "t", "n", "root", "component")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row.

    Null and empty texts, and texts of white space, are linked with nothing; a text of fewer than
    five words is one shingle. Repeated rows and equal texts are one class. Rows with a null id
    take part but don't name a component (a component of such rows alone has a null id, and
    kept is null). Rows that share an id but not a text are compared by their texts. Any other
    columns are ignored; an empty table gives an empty result.
    """
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    rows = _grouped(docs, id_col, text_col, percent)
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("id") == component).alias("kept"))


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row of docs for each group of near-duplicates, with all its columns, and all rows without words.

    It is that with the smallest id, or, of rows with one id or none, the smallest print of the text;
    of repeated rows (equal id and text) one stays, whichever it is if their other columns differ. Rows go by id and text, so that another text
    under the same id stays if its own group needs it.
    """
    rows, _ = saved(_grouped(docs, id_col, text_col, percent).where("n > 0").select("id", "t", "root"), "grouped")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "t")
    best = rows.groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("n")).where("n > 1")
    several = rows.join(best, "root")
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("t") == F.col("best.t"))
    gone, _ = saved(several.where(~stays).select("id", "t").distinct(), "gone")
    twice, _ = saved(several.where(stays).groupBy("id", "t").agg(F.count("*").alias("n")).where("n > 1").select("id", "t"), "twice")

    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row")
    own = docs.select(row, F.col(f"`{id_col}`").cast("long").alias("own"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("print"))
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("print") == F.col("t"))
    gone = listed(gone, BROADCAST_IDS)
    left = own.join(gone, same, "left_anti")
    if twice.limit(1).count():
        one = left.join(twice, same, "left_semi").groupBy("own", "print").agg(F.first("row").alias("row")).select("row", "own", "print")
        left = left.join(twice, same, "left_anti").unionByName(one)
    return left.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
