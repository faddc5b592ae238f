"""Blocks of Markdown documents of any length: a row for each line, and a table function that carries fence and headings.

``blocks.citation_blocks`` holds a document in one row and folds over its lines, in time that grows
faster than they do. Here a document is rows: what a line is by itself is decided by the same
expressions, and a partitioned Arrow table function passes each document's lines once, in order. It
holds the open fence, the path of headings and the lines of one block, never a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.documents import stripped
from sparkloom.functions.provenance import block_ref
from sparkloom.functions.text import collapse, normalize_markdown
from sparkloom.operators.blocks import FENCE, HEADING, LINE_END, kind_of

#: What a line is outside a fence.
_TEXT, _EMPTY, _HEADING = 0, 1, 2
_MADE = "ordinal int, copies int, heading_path array<string>, text string"
#: Blocks are handed on after this many, and after each batch of lines.
_BATCH = 1024


class _Blocks:
    """One document's lines in order; lines of one number are copies of each other, from rows that are equal."""

    def __init__(self):
        self.made: list[dict] = []
        self.key, self.n, self.copies = None, None, 0
        self.first: tuple | None = None  # the first line waits until its copies are counted
        self.open, self.path, self.lines, self.ordinal = "", [], [], 0

    def _end(self) -> None:
        if self.lines:
            self.ordinal += 1
            row = {"ordinal": self.ordinal, "copies": self.copies, "heading_path": [t for _, t in self.path], "text": "\n".join(self.lines)}
            self.made.append({"own": self.key} | row)
            self.lines = []

    def _line(self, line: str, kind: int, mark: str, level: int, title: str) -> None:
        if self.open or mark:
            self.lines.append(line)
            self.open = self.open or mark if self.open != mark else ""
        elif kind == _TEXT:
            self.lines.append(line)
        else:
            self._end()
            if kind == _HEADING:
                self.path = [*(h for h in self.path if h[0] < level), (level, title)]
                self.lines.append(line)
                self._end()

    def _start(self) -> None:
        if self.first is not None:
            self._line(*self.first)
            self.first = None

    def _out(self, schema: pa.Schema) -> pa.Table:
        made, self.made = self.made, []
        return pa.Table.from_pylist(made, schema)

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        self.schema = pa.schema([rows.schema.field("own"), ("ordinal", pa.int32()), ("copies", pa.int32()), ("heading_path", pa.list_(pa.string())), ("text", pa.string())])
        if self.key is None and rows.num_rows:
            self.key = rows.column("own")[0].as_py()
        names = ("n", "line", "kind", "mark", "level", "title")
        for n, line, *about in zip(*(rows.column(c).to_pylist() for c in names), strict=True):
            if self.n is None:
                self.first, self.n, self.copies = (line, *about), n, 1
            elif n == self.n:
                self.copies += self.first is not None
            else:
                self._start()
                self.n = n
                self._line(line, *about)
            if len(self.made) >= _BATCH:
                yield self._out(self.schema)
        if self.made:
            yield self._out(self.schema)

    def terminate(self) -> Iterator[pa.Table]:
        self._start()
        self._end()
        if self.made:
            yield self._out(self.schema)


def blocks_of_lines(lines: DataFrame, keys: list[str], n: str, line: str) -> DataFrame:
    """``keys, ordinal, ref, kind, heading_path, text``: a row for each block of the documents that keys tell apart.

    lines has a row for each line, numbered by n in any steps; a document's lines in order, joined by
    newlines, must be in normal form, as normalize_markdown() gives it. Repeated rows (one key, one
    number) are copies of a document: each block comes as often as the document's first line.
    A null line is an empty one; a line without a number is left out; no lines, no blocks. Other columns are ignored.
    """
    text = F.coalesce(F.col(f"`{line}`"), F.lit(""))
    rows = lines.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("own"), F.col(f"`{n}`").cast("long").alias("n"), text.alias("line")).where("n is not null")
    bare = stripped(F.col("line"))
    kind = F.when(bare == "", _EMPTY).when(bare.rlike(HEADING), _HEADING).otherwise(_TEXT)
    about = rows.select("own", "n", "line", kind.alias("kind"), F.regexp_extract("line", FENCE, 1).alias("mark"), F.length(F.regexp_extract(bare, HEADING, 1)).alias("level"), collapse(F.regexp_extract(bare, HEADING, 2)).alias("title"))
    carry = F.arrow_udtf(_Blocks, returnType=f"own {rows.schema['own'].dataType.simpleString()}, {_MADE}")
    made = carry(about.asTable().partitionBy("own").orderBy("n")).withColumn("text", stripped(F.col("text")))
    made = made.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return made.select(*[F.col("own")[k].alias(k) for k in keys], "ordinal", block_ref(F.col("ordinal"), F.col("text")).alias("ref"), kind_of(F.col("text")).alias("kind"), "heading_path", "text")


def long_citation_blocks(df: DataFrame, keys: list[str], markdown: str) -> DataFrame:
    """What citation_blocks() gives, in time that grows as the lines do. Documents that share keys are told apart by a hash of their texts."""
    own = [f"k{i}" for i in range(len(keys))]
    made = df.where(F.col(f"`{markdown}`").isNotNull()).select(*[F.col(f"`{k}`").alias(o) for k, o in zip(keys, own, strict=True)], normalize_markdown(F.col(f"`{markdown}`")).alias("text"))
    rows = made.select(*own, F.sha2("text", 256).alias("print"), F.posexplode(F.split("text", LINE_END, -1)).alias("n", "line"))
    out = blocks_of_lines(rows, [*own, "print"], "n", "line")
    return out.select(*[F.col(o).alias(k) for k, o in zip(keys, own, strict=True)], "ordinal", "ref", "kind", "heading_path", "text")
