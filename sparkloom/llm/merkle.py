"""Merkle manifest of a dataset, with proofs by lookups of coordinates.

Each row is a leaf; the leaves of a group (a source) form a tree, and the trees' roots form one
more. A node table is materialised once: a row for each run of ARITY siblings, at the coordinates
(tree, level, run), with the digests of the run in order. A leaf's proof needs the runs at
coordinates that follow from its place and the size of its tree: they are exploded, joined with the
node table, ordered, concatenated, and folded from the leaf up.

Sixteen leaves of a run share all coordinates above it, 4096 runs all those three levels
further up, and so on. So coordinates are exploded three levels at a time, once for those that share
them: no key of a join has more than 4096 rows, however large a group is, and a leaf takes part in
one join with its run. Leaves get their places by one range partitioning and sums over partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import fresh_path, saved

ARITY = 16
#: Rows (about) of one partition in which leaves are numbered.
CHUNK_ROWS = 250_000
#: Levels whose coordinates are exploded at a time.
STEP = 3
#: The tree of the trees' roots.
TOP = -1
_HEX = 64


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its UTF-8 byte count, a colon, and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """The digest of a row's fields."""
    return F.sha2(F.concat(*[field(x) for x in values]).cast("binary"), 256)


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _whole(at: Column, by: int) -> Column:
    return F.floor(at / F.lit(by)).cast("long")


def _over(n: Column, by: int) -> Column:
    """n / by, rounded up."""
    return _whole(n + (by - 1), by)


def _numbered(rows: DataFrame, n_rows: int) -> DataFrame:
    """Adds ``tree`` (its group's place), ``at`` (the row's place in it) and ``n`` (rows of the group).

    rows: saved, with g, id, leaf, salt. Ranges of (g, id, leaf, salt) are numbered each on its own;
    what precedes a range comes from sums over the counts of groups in ranges.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // CHUNK_ROWS))
    order = ["g", "id", "leaf", "salt"]
    ranged, _ = saved(rows.repartitionByRange(parts, *order).withColumn("p", F.spark_partition_id()), "ranged")
    counts, _ = saved(ranged.groupBy("p", "g").agg(F.count("*").alias("c")), "counts")
    own, part = Window.partitionBy("g"), Window.partitionBy("p").orderBy("g")
    counts = counts.withColumns({
        "first": (F.col("p") == F.min("p").over(own)).cast("long"), "n": F.sum("c").over(own),
        "before": F.sum("c").over(own.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c"),
    })
    counts = counts.withColumns({"o": F.row_number().over(part), "ahead": F.sum("c").over(part.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c"), "begun": F.sum("first").over(part.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    ranges = counts.groupBy("p").agg(F.sum("first").alias("f"))  # a row for each partition
    ranges = ranges.select("p", (F.sum("f").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("f")).alias("earlier"))
    counts = counts.join(F.broadcast(ranges), "p").withColumn("tree", F.max(F.when(F.col("first") == 1, F.col("earlier") + F.col("begun") - 1)).over(own))
    placed, _ = saved(counts.select("p", "o", "tree", "n", (F.col("before") - F.col("ahead")).alias("shift")), "placed")
    within = Window.partitionBy("p")
    rows = ranged.withColumns({"o": F.dense_rank().over(within.orderBy("g")), "i": F.row_number().over(within.orderBy(*order))})
    return rows.join(placed, ["p", "o"]).withColumn("at", F.col("i") - 1 + F.col("shift")).drop("p", "o", "i", "shift", "salt")


def _grow(nodes: DataFrame, path: str, most: int, arity: int) -> None:
    """Write the runs of all levels of the trees of nodes (``tree, at, n, node``) to path; most: nodes of the largest."""
    spark, level = nodes.sparkSession, 0
    while most > 1:
        runs = nodes.where("n > 1").groupBy("tree", _whole(F.col("at"), arity).alias("run"))
        kids = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("at", "node"))), lambda x: x["node"]))
        runs.agg(F.first("n").alias("n"), kids.alias("kids")).write.parquet(f"{path}/level={level}")
        written = spark.read.schema("tree long, run long, n long, kids string").parquet(f"{path}/level={level}")
        nodes = written.select("tree", F.col("run").alias("at"), _over(F.col("n"), arity).alias("n"), _digest(F.col("kids")).alias("node"))
        most, level = -(-most // arity), level + 1


def _read(df: DataFrame, path: str, levels: int) -> DataFrame:
    """The runs below path as ``tree, level, run, n, kids``; n: nodes of the tree at that level."""
    schema = "tree long, run long, n long, kids string"
    found = [df.sparkSession.read.schema(schema).parquet(f"{path}/level={k}").select("tree", F.lit(k).alias("level"), "run", "n", "kids") for k in range(levels)]
    empty = df.sparkSession.createDataFrame([], "tree long, level int, run long, n long, kids string")
    return reduce(DataFrame.unionAll, found, empty)


def _levels(most: int, arity: int) -> int:
    k = 0
    while most > 1:
        most, k = -(-most // arity), k + 1
    return k


@dataclass
class Manifest:
    """leaves: ``id, g, leaf, tree, at, n`` and carried columns; nodes: ``tree, level, run, n, kids``; groups: ``tree, subroot``.

    path has the saved node tables (``groups`` and ``top``); root is null for an empty dataset.
    """

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None
    path: str
    most: tuple[int, int]
    arity: int


def build_manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "source", carried: dict[str, Column] | None = None, arity: int = ARITY) -> Manifest:
    """The trees over the rows of docs; only digests are exchanged.

    A group's leaves ascend by id (null first), rows that share an id by digest; groups ascend by
    name, null first. Every row is a leaf, repeated ones too. carried: more columns of the leaves, as
    expressions over docs (names other than those of Manifest). Other columns are ignored.
    """
    row = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{group_col}`").cast("string").alias("g"), leaf([F.col(f"`{c}`") for c in fields]).alias("leaf"),
        F.monotonically_increasing_id().alias("salt"), *[x.alias(c) for c, x in (carried or {}).items()],
    )
    hashed, _ = saved(row, "hashed")
    leaves, _ = saved(_numbered(hashed, hashed.count()), "leaves")
    path = fresh_path(docs.sparkSession, "merkle")
    most, trees = leaves.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("tree") + 1, F.lit(0))).first()
    _grow(leaves.select("tree", "at", "n", F.col("leaf").alias("node")), f"{path}/groups", most, arity)
    runs = _read(docs, f"{path}/groups", _levels(most, arity))
    lone = leaves.where("n = 1").select("tree", F.col("leaf").alias("subroot"))
    groups, _ = saved(lone.unionAll(runs.where(F.col("n") <= arity).select("tree", _digest(F.col("kids")).alias("subroot"))), "subroots")
    _grow(groups.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(trees).cast("long").alias("n"), F.col("subroot").alias("node")), f"{path}/top", trees, arity)
    top = _read(docs, f"{path}/top", _levels(trees, arity))
    last = groups.select("subroot") if trees == 1 else top.where(F.col("n") <= arity).select(_digest(F.col("kids")))
    root = (last.first() or [None])[0] if trees else None
    return Manifest(leaves, runs.unionAll(top), groups, root, path, (most, trees), arity)


def _paths(m: Manifest, units: DataFrame, height: int, most: int, above: DataFrame) -> DataFrame:
    """``tree, at, path`` and the columns of above: for each unit (``tree, at, n``) at a height, the runs from there to the root.

    path: ``(level, pos, kids)`` in order. above: ``tree, path`` and more, for each tree's root.
    """
    if most <= 1:
        return units.select("tree", "at").join(above, "tree")
    a = m.arity
    step = a**STEP
    at, n = F.col("at"), F.col("n")
    wanted = [F.when(n > a**k, F.struct(F.lit(height + k).alias("level"), _whole(at, a ** (k + 1)).alias("run"), F.pmod(_whole(at, a**k), F.lit(a)).cast("int").alias("pos"))) for k in range(STEP)]
    coordinates = units.select("tree", "at", F.explode(F.array_compact(F.array(*wanted))).alias("x")).select("tree", "at", "x.*")
    found = coordinates.join(m.nodes.select("tree", "level", "run", "kids"), ["tree", "level", "run"])
    own = found.groupBy("tree", "at").agg(F.array_sort(F.collect_list(F.struct("level", "pos", "kids"))).alias("own"))
    upper = units.groupBy("tree", _whole(at, step).alias("at")).agg(F.max(_over(n, step)).alias("n"))
    upper = _paths(m, upper, height + STEP, -(-most // step), above).withColumnRenamed("at", "up")
    rows = units.select("tree", "at", _whole(at, step).alias("up")).join(own, ["tree", "at"], "left").join(upper, ["tree", "up"]).drop("up")
    return rows.withColumn("path", F.concat(F.coalesce("own", F.slice("path", 1, 0)), "path")).drop("own")


def proofs(m: Manifest) -> DataFrame:
    """The manifest's leaves with ``subroot`` and ``path``: ``(level, pos, kids)`` for each run from the leaf to the root."""
    empty = F.array().cast("array<struct<level:int,pos:int,kids:string>>")
    roots = m.groups.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(m.most[1]).cast("long").alias("n"))
    end = m.groups.sparkSession.createDataFrame([(TOP,)], "tree long").withColumn("path", empty)
    top = _paths(m, roots, 0, m.most[1], end).select(F.col("at").alias("tree"), "path").join(m.groups, "tree")
    run = _whole(F.col("at"), m.arity)
    units = m.leaves.groupBy("tree", run.alias("at")).agg(_over(F.max("n"), m.arity).alias("n"))
    upper = _paths(m, units, 1, -(-m.most[0] // m.arity), top).withColumnRenamed("at", "run")
    upper = upper.join(m.nodes.where("level = 0").select("tree", "run", "kids"), ["tree", "run"], "left")
    rows = m.leaves.withColumn("run", run).join(upper, ["tree", "run"])
    own = F.struct(F.lit(0).alias("level"), F.pmod("at", F.lit(m.arity)).cast("int").alias("pos"), "kids")
    return rows.withColumn("path", F.concat(F.when(F.col("kids").isNull(), empty).otherwise(F.array(own)), "path")).drop("kids", "run")


def _left(x: Column) -> Column:
    return F.substr(x["kids"], F.lit(1), x["pos"] * _HEX)


def _right(x: Column) -> Column:
    return F.substr(x["kids"], x["pos"] * _HEX + _HEX + 1)


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as one text of digests."""
    return F.concat_ws("", F.transform(path, lambda x: F.concat(_left(x), _right(x))))


def folded(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf_digest, lambda now, x: _digest(F.concat(_left(x), now, _right(x))))


def tampered_check(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), arity: int = ARITY) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for each row.

    Where five divides the crc32 of the decimal id, the leaf is folded from a text whose A-Z are
    lower-cased (a row without id isn't tampered). Nulls in any field are ``-``; rows that share an id
    are ordered by digest, so that equal rows may exchange places; an empty table gives an empty result.
    """
    text = F.translate(F.col(f"`{text_col}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = leaf([text if c == text_col else F.col(f"`{c}`") for c in fields])
    chosen = F.crc32(F.col(f"`{id_col}`").cast("long").cast("string").cast("binary")) % 5 == 0
    m = build_manifest(docs, list(fields), id_col, group_col, {"changed": F.when(chosen, changed)}, arity)
    root = F.lit(m.root).cast("string")
    rows = proofs(m).withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"), _digest(siblings(F.col("path"))).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified")
    )
