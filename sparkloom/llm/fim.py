"""Fill-in-the-middle examples, cut by a sparse index of checkpoints.

A text is counted once, block by block, in units: runs of letters A-Z and a-z, and single other
code points. While counting, every EVERY-th unit leaves a checkpoint: its number, its byte offset
and its code-point offset. A cut after k units is found by binary search among the checkpoints and
a rescan of fewer than EVERY units from there, so that no list of units is ever made: a text of
any length takes its own bytes, one block's masks and three numbers for each EVERY units.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import small_batches

#: Units between checkpoints; bytes that are counted at a time.
EVERY, BLOCK = 128, 1 << 16

_UNIT = re.compile(rb"([A-Za-z]+)|[\x00-\x7F]|[\xC0-\xFF][\x80-\xBF]*")
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Checkpoints:
    """The units of a UTF-8 text: how many, and where each begins."""

    def __init__(self, text: bytes, every: int = EVERY):
        self.text, self.units, self.points = text, 0, 0
        unit, byte, point, after_letter = [], [], [], False
        for at in range(0, len(text), BLOCK):
            block = np.frombuffer(text, np.uint8, min(BLOCK, len(text) - at), at)
            letter, first = _LETTER[block], (block & 0xC0) != 0x80  # first: of a code point
            follows = np.empty(len(block), bool)
            follows[0], follows[1:] = after_letter, letter[:-1]
            begins = np.flatnonzero(first & ~(letter & follows))
            skip = -self.units % every
            marks = begins[skip::every]
            unit.append(self.units + skip + every * np.arange(len(marks)))
            byte.append(at + marks)
            point.append(self.points + np.cumsum(first)[marks] - 1)
            self.units, self.points, after_letter = self.units + len(begins), self.points + int(first.sum()), bool(letter[-1])
        self.unit, self.byte, self.point = (np.concatenate(x).tolist() if x else [] for x in (unit, byte, point))

    def place(self, k: int) -> tuple[int, int]:
        """(byte, code point) at which the first k units end."""
        if k >= self.units:
            return len(self.text), self.points
        i = bisect_right(self.unit, k) - 1
        byte, point = self.byte[i], self.point[i]
        for _ in range(k - self.unit[i]):
            unit = _UNIT.match(self.text, byte)
            point += unit.end() - byte if unit[1] else 1
            byte = unit.end()
        return byte, point


@dataclass(frozen=True)
class Recipe:
    """Sentinels, the salt of the draws, and shares in percent: of plain texts, and of the rest that put the suffix first."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "1:"
    plain: int = 10
    suffix_first: int = 20


def _transform(ids: pa.Array, texts: pa.Array, recipe: Recipe) -> pa.Array:
    marks = [x.encode() for x in (recipe.prefix, recipe.suffix, recipe.middle)]
    p, s, m = marks
    n, form, before, between, out = [], [], [], [], []
    for doc_id, text in zip(ids.to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True):
        text = text or b""
        draw = sha256(f"{recipe.seed}{'' if doc_id is None else doc_id}".encode()).digest()
        h = [int.from_bytes(draw[k : k + 4]) for k in (0, 4, 8, 12)]
        index = Checkpoints(text)
        n.append(index.units)
        if not text or any(x in text for x in marks) or h[2] % 100 >= 100 - recipe.plain:
            form.append("plain"), before.append(None), between.append(None), out.append(text)
            continue
        (a, i), (b, j) = (index.place(k) for k in sorted(x % (index.units + 1) for x in h[:2]))
        before.append(i), between.append(j - i)
        if h[3] % 100 < recipe.suffix_first:
            form.append("spm"), out.append(b"".join((s, text[b:], p, text[:a], m, text[a:b])))
        else:
            form.append("psm"), out.append(b"".join((p, text[:a], s, text[b:], m, text[a:b])))
    columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(between, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
    return pa.StructArray.from_arrays(columns, ["n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", into: str = "fim", recipe: Recipe = Recipe()) -> DataFrame:
    """docs with a struct column: ``n`` units, ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars``, ``output`` text.

    A null text counts as empty, and an empty text or one that holds a sentinel is plain, with null
    lengths. Draws depend on the id alone (a null id has no digits), so that repeated rows are cut
    alike. All columns stay, but one named as the new column is replaced. No row moves: the texts
    are cut where they are read. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def made(ids: pa.Array, texts: pa.Array) -> pa.Array:
        return _transform(ids, texts, recipe)

    return docs.withColumn(into, made(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")))


def restored(output: Column, form: Column, recipe: Recipe = Recipe()) -> Column:
    """The exact text of an output: prefix, middle and suffix are put back from between the sentinels."""
    after = lambda mark: F.substring_index(output, mark, -1)
    before = lambda text, mark: F.substring_index(text, mark, 1)
    psm = F.concat(F.substr(before(output, recipe.suffix), F.lit(len(recipe.prefix) + 1)), after(recipe.middle), before(after(recipe.suffix), recipe.middle))
    spm = F.concat(before(after(recipe.prefix), recipe.middle), after(recipe.middle), F.substr(before(output, recipe.prefix), F.lit(len(recipe.suffix) + 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fim_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recipe: Recipe = Recipe()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` for each row; cases as in fill_in_middle()."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    made = fill_in_middle(rows, "doc_id", "text", "fim", recipe).select("doc_id", "fim.*")
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"), recipe)).alias("restored_sha256"))
