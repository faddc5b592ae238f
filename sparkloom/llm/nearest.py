"""Nearest neighbours by block matrix join.

Vectors are scaled to int8; tiles of queries and candidates are multiplied as int8 matrices (their
sums are whole numbers that a float holds exactly), and the scales and lengths of the rounding
errors bound how far each product can be from the true one. A pair whose upper bound is below the
best lower bounds found so far can't be among the nearest; the others are computed again in double
precision, and small heaps keep each query's best. The result is exact.

Queries are dealt into blocks of bounded bytes and candidates into parts. One exchange brings each
part of the candidates together with each block of queries: a task holds its block and streams its
part past it in tiles. The driver sees two counts, whatever the size.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import small_batches

#: Bytes of query vectors in a block and of candidate vectors in a part (less, where that leaves cores idle), candidates and queries in a tile.
BLOCK_BYTES, PART_BYTES, TILE, QUERY_TILE = 16 << 20, 256 << 20, 2048, 1024


def _quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as floats, for the matrix product), scales, lengths, and lengths of the errors."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    near = q * scale[:, None]
    up = 1 + 1e-9
    return q.astype(np.int8), scale, np.sqrt((near * near).sum(axis=1)) * up, np.sqrt(((x - near) ** 2).sum(axis=1)) * up


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of their components."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


class _Heap:
    """The k best (score, smaller id first) of each query."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def merge(self, first: int, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Pairs of queries (from row first on) and candidates; only queries with pairs are touched."""
        if not len(q):
            return
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        who, start, n = np.unique(q, return_index=True, return_counts=True)
        place = np.arange(len(q)) - np.repeat(start, n)
        best = place < self.k
        row = np.repeat(np.arange(len(who)), n)[best]
        s = np.full((len(who), 2 * self.k), -np.inf)
        i = np.full((len(who), 2 * self.k), np.iinfo(np.int64).max)
        s[:, : self.k], i[:, : self.k] = self.score[first + who], self.id[first + who]
        s[row, self.k + place[best]], i[row, self.k + place[best]] = scores[best], ids[best]
        pick = np.lexsort((i, -s), axis=1)[:, : self.k]
        self.score[first + who], self.id[first + who] = np.take_along_axis(s, pick, 1), np.take_along_axis(i, pick, 1)


def _segments(batches):
    """Yields (block, whether these are candidates, ids, vectors) for runs of rows of one block and side."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in ("dim", "part", "block", "side")]
        new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in keys], axis=0)) + 1
        for a, b in zip([0, *new], [*new, batch.num_rows], strict=True):
            dim = int(keys[0][a])
            rows = batch.column("v").slice(a, b - a).flatten().to_numpy().astype(np.float64).reshape(-1, dim)
            yield (dim, int(keys[1][a]), int(keys[2][a])), bool(keys[3][a]), batch.column("id").to_numpy()[a:b], rows


class _Block:
    """A block of queries, past which one part of the candidates streams."""

    def __init__(self, k: int):
        self.k, self.heap, self.n = k, None, 0
        self.asked: list = []
        self.held: list = []

    def add(self, candidates: bool, ids: np.ndarray, rows: np.ndarray) -> None:
        (self.held if candidates else self.asked).append((ids, rows))
        self.n += len(ids) * candidates
        if self.n >= TILE:
            self.compare()

    def compare(self) -> None:
        """The held candidates as one tile against all queries."""
        if self.held and self.asked:
            if self.heap is None:
                self.ids, self.rows = (np.concatenate(x) for x in zip(*self.asked, strict=True))
                self.heap = _Heap(len(self.ids), self.k)
                self.int8 = _quantised(self.rows)
            ids, rows = (np.concatenate(x) for x in zip(*self.held, strict=True))
            self._tile(ids, rows)
        self.held, self.n = [], 0

    def _tile(self, ids: np.ndarray, rows: np.ndarray) -> None:
        kind = np.float32 if rows.shape[1] * 127 * 127 < 1 << 24 else np.float64
        qq, qs, ql, qe = self.int8
        cq, cs, cl, ce = _quantised(rows)
        cq = cq.astype(kind).T
        norm = cl + ce
        for a in range(0, len(qq), QUERY_TILE):
            b = min(len(qq), a + QUERY_TILE)
            near = (qq[a:b].astype(kind) @ cq).astype(np.float64) * qs[a:b, None] * cs
            error = (qe[a:b, None] * norm + ql[a:b, None] * ce) * (1 + 1e-9) + 1e-12 * (ql[a:b, None] + qe[a:b, None]) * norm
            near[self.ids[a:b, None] == ids] = -np.inf
            least = self.heap.score[a:b, -1]
            if len(ids) > self.k:
                least = np.maximum(least, np.partition(near - error, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
            q, c = np.nonzero((near + error >= least[:, None]) & (near > -np.inf))
            self.heap.merge(a, q, ids[c], exact_product(self.rows[a + q], rows[c]))

    def best(self):
        """The k best candidates of this part for each query of the block."""
        self.compare()
        if self.heap is None:
            return
        q, place = np.nonzero(self.heap.score > -np.inf)
        for a in range(0, len(q), 50_000):
            i, j = q[a : a + 50_000], place[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[i]), pa.array(self.heap.id[i, j]), pa.array(self.heap.score[i, j])], ["query_id", "vec_id", "score"])


def _search(batches, k: int):
    """The best candidates of each block; rows come by block, queries before candidates."""
    now, block = None, _Block(k)
    for key, candidates, ids, rows in _segments(batches):
        if key != now:
            yield from block.best()
            now, block = key, _Block(k)
        block.add(candidates, ids, rows)
    yield from block.best()


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v``: the distinct rows with vectors of finite components that are not all zero."""
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).distinct()


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k candidates with the largest inner products.

    All other candidates if there are fewer; ties go to the smaller id. Null, zero and non-finite
    vectors, and null ids, take no part; only vectors of one dimension are compared with one
    another. Repeated rows (equal id and vector) count once; each vector of an id with several is a
    candidate of its own, and of a query id with several the k best of all its vectors' candidates
    are given. A candidate never has its query's id.
    Other columns are ignored; empty tables give an empty result.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    good, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    size = lambda df: df.agg(F.coalesce(F.sum(F.size("v") * 8), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    of_asked, of_good = size(asked), size(good)
    blocks = -(-of_asked["bytes"] // BLOCK_BYTES) or 1
    parts = max(-(-of_good["bytes"] // PART_BYTES), min(spark.sparkContext.defaultParallelism, -(-of_good["n"] // TILE))) or 1
    dealt = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = asked.select(F.size("v").alias("dim"), all_of(parts).alias("part"), dealt(blocks, "block").alias("block"), F.lit(0).alias("side"), "id", "v")
    rows = rows.unionAll(good.select(F.size("v"), dealt(parts, "part"), all_of(blocks), F.lit(1), "id", "v"))
    order = ["dim", "part", "block"]
    met = rows.repartition(parts * blocks, *order).sortWithinPartitions(*order, "side", "id")
    found = met.mapInArrow(partial(_search, k=k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
