"""Blocks of documents by lines, against the blocks of documents in one row."""

import random
import time

from pyspark.sql import functions as F

PIECES = ["# One", "##  Two words  ", "### Three\t", "#no", "####### seven", "```", "~~~", "  ```py", "text | more", "- item", "3) item", "> said", "", "   ", "| a | b |", "x # y", "ünï ", " ", "a\u0085b", "# Wide"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def both(rows, keys):
    from sparkloom.operators.blocks import citation_blocks
    from sparkloom.operators.long_blocks import long_citation_blocks

    return rows_of(long_citation_blocks(rows, keys, "md")), rows_of(citation_blocks(rows, keys, "md"))


def test_equal_to_blocks_of_rows(spark):
    """Random documents: fences of both marks, never closed ones, skipped levels, all line ends; nulls, empty texts, repeated rows, keys shared by other texts, null keys."""
    rng = random.Random(3)
    texts = [rng.choice(["\n", "\r\n", "\x0b"]).join(rng.choices(PIECES, k=rng.randrange(40))) for _ in range(150)]
    rows = [(i % 140, i % 3 or None, t, "x") for i, t in enumerate(texts)] + [(1, 1, None, "x"), (2, 2, "", "x"), (3, None, "# same\n\ntext", "x"), (3, None, "# same\n\ntext", "x"), (3, None, "# same\n\ntext", "y")]
    got, want = both(spark.createDataFrame(rows, "a int, n int, md string, line string"), ["a", "n"])
    assert got == want and len(got) > 500
    assert both(spark.createDataFrame([], "a int, n int, md string"), ["a", "n"]) == ([], [])


def test_lines_without_a_text(spark):
    """Numbers in any steps; null lines are empty; a line without a number is left out; other columns are ignored."""
    from sparkloom.operators.long_blocks import blocks_of_lines

    rows = spark.createDataFrame([("d", 50, "tail", 1), ("d", -7, "# Top", 2), ("d", 3, None, 3), ("d", None, "lost", 4), ("e", 0, "alone", 5)], "own string, n long, line string, kind int").repartition(3)
    got = [(r["own"], r["ordinal"], r["kind"], r["heading_path"], r["text"]) for r in blocks_of_lines(rows, ["own"], "n", "line").orderBy("own", "ordinal").collect()]
    assert got == [("d", 1, "heading", ["Top"], "# Top"), ("d", 2, "paragraph", ["Top"], "tail"), ("e", 1, "paragraph", [], "alone")]


def test_a_million_lines(spark):
    """Time grows as the lines do: ten times as many take at most twenty times as long; the counts are those of the rule that made the lines."""
    from sparkloom.operators.long_blocks import blocks_of_lines

    def run(n):
        line = F.when(F.col("id") % 1000 == 0, F.concat(F.lit("# Part "), (F.col("id") / 1000).cast("long"))).when(F.col("id") % 4 == 1, "").otherwise(F.concat(F.lit("line "), "id"))
        lines = spark.range(n).select(F.lit(1).alias("doc"), F.col("id").alias("n"), line.alias("line"))
        began = time.time()
        out = blocks_of_lines(lines, ["doc"], "n", "line").groupBy("kind").agg(F.count("*").alias("n"), F.max(F.size("heading_path")).alias("deep")).collect()
        return {r["kind"]: (r["n"], r["deep"]) for r in out}, time.time() - began

    run(1000)
    small, t = run(100_000)
    large, s = run(1_000_000)
    assert small == {"heading": (100, 1), "paragraph": (25_000, 1)} and large == {"heading": (1000, 1), "paragraph": (250_000, 1)}
    assert s < 20 * max(t, 1)
