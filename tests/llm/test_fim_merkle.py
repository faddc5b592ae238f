"""Fill-in-the-middle and the Merkle manifest against plain restatements."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_against_brute_force import frame, odd_rows, same

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts():
    rng = random.Random(8)
    rows = [(None, "no id, some words here"), (400, "a <P> in it"), (401, "<S><M>"), (402, "<"), (403, "éa1 b 😀zz\x00\n" * 50), (404, "z" * 200_000), (405, "." * 200_000)]
    rows += [(1000 + i, "".join(rng.choice(["a", "Bc", " ", "é", "😀", "<", ">", "P", "\n", "9"]) for _ in range(rng.randint(0, 300)))) for i in range(300)]
    return odd_rows() + rows + rows[:9]


def test_fill_in_middle(spark):
    from sparkloom.llm.fim import fill_in_middle, fim_round_trip

    want = brute.fill_in_middle(texts())
    docs = frame(spark, texts())
    same(fim_round_trip(docs), [(*r[:5], digest(r[5]), digest(r[6])) for r in want])
    made = fill_in_middle(docs, into="n")  # a column of that name is replaced
    assert made.columns == docs.columns
    same(made.select("doc_id", "n.n", "n.form", "n.prefix_chars", "n.middle_chars", "n.output"), [r[:6] for r in want])
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    assert fim_round_trip(frame(spark, [])).count() == 0


def test_fill_in_middle_moves_no_rows(spark):
    from sparkloom.llm.fim import fim_round_trip

    plan = fim_round_trip(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython [") == 1


@pytest.mark.parametrize("every", [1, 2, 7, 128])
def test_checkpoints_find_every_place(every, monkeypatch):
    import re

    from sparkloom.llm import fim

    monkeypatch.setattr(fim, "BLOCK", 13)
    for _, text in texts()[:90]:
        text = (text or "")[:700]
        units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
        index = fim.Checkpoints(text.encode(), every)
        assert index.units == len(units) and len(index.unit) == -(-len(units) // every)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert index.place(k) == (len(head.encode()), len(head))


def leaves():
    rng = random.Random(3)
    rows = [(i, "hot", rng.choice(["en", None]), i, f"Text {i}") for i in range(700)]
    rows += [(rng.randint(0, 5000), f"s{rng.randint(0, 40)}", "de", None, rng.choice(["ABC é", "", None, "same"])) for _ in range(300)]
    return rows + [(None, None, None, None, None), (None, None, None, None, "x"), (7, None, "", 0, ""), (5, "é", "en", 1, "T"), (5, "é", "en", 1, "T"), (5, "é", "en", 2, "U")]


@pytest.mark.parametrize("arity", [2, 16])
def test_merkle_proofs(spark, arity):
    from sparkloom.llm.merkle import tampered_check

    for rows in (leaves(), leaves()[700:], [(3, None, "en", 1, "Abc")]):
        docs = spark.createDataFrame(rows, SCHEMA).withColumns({"tree": F.lit(1), "at": F.lit("x"), "path": F.lit(None).cast("string"), "g": F.lit(2)})
        got = tampered_check(docs, arity=arity)
        same(got, brute.merkle(rows, arity))
    assert tampered_check(spark.createDataFrame([], SCHEMA)).count() == 0


def test_merkle_over_many_ranges(spark, monkeypatch):
    from sparkloom.llm import merkle

    monkeypatch.setattr(merkle, "CHUNK_ROWS", 20)
    same(merkle.tampered_check(spark.createDataFrame(leaves(), SCHEMA).repartition(7)), brute.merkle(leaves()))


def test_merkle_nodes_are_materialised_and_keys_are_bounded(spark):
    from sparkloom.llm.merkle import build_manifest, proofs

    docs = spark.createDataFrame([(i, "one", "en", 1, str(i)) for i in range(6000)], SCHEMA)
    m = build_manifest(docs, ["doc_id", "text"])
    kids = spark.read.parquet(f"{m.path}/groups").groupBy("level").agg(F.count("*").alias("n"), F.sum(F.length("kids")).alias("chars")).orderBy("level").collect()
    assert [(r["n"], r["chars"]) for r in kids] == [(375, 6000 * 64), (24, 375 * 64), (2, 24 * 64), (1, 2 * 64)]
    assert {len(r["path"]) for r in proofs(m).collect()} == {4}
