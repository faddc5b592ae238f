"""Mergeable roll-ups against full recomputations on random runs, and appends that read no stored bodies."""

import random

from pyspark.sql import functions as F

SCHEMA = "source_id string, url string, run_id long, at string"


def runs(n, seed):
    rng = random.Random(seed)
    for run in range(n):
        yield [(rng.choice(["a", "b", None]), f"u{rng.randint(0, 30)}", run, f"2024-{rng.randint(1, 12):02d}") for _ in range(rng.randint(1, 25))]


def test_states_equal_the_full_recomputation_after_every_run(spark, tmp_path, monkeypatch):
    from sparkloom.operators import incremental, ledger

    monkeypatch.setattr(incremental, "FAN", 3)
    rollup = incremental.Rollup(spark, str(tmp_path / "r"), ["source_id", "url"])
    seen, everything = {}, []
    for k, rows in enumerate(runs(11, 4)):
        everything += rows
        got = rollup.add(spark.createDataFrame(rows, SCHEMA), f"run {k}")
        keys = {r[:2] for r in rows}
        assert {(r["source_id"], r["url"]): r["classification"] for r in got.collect()} == {x: "known" if x in seen else "new" for x in keys}
        seen |= dict.fromkeys(keys)
    frame = spark.createDataFrame(everything, SCHEMA)
    once = frame.groupBy("source_id", "url", "run_id").agg(F.min("at").alias("at"))
    full = ledger.candidates(once, ["source_id", "url"], "run_id", "at")
    assert sorted(map(str, rollup.candidates().collect())) == sorted(map(str, full.collect()))
    live = rollup._live(rollup._log())
    assert sorted(r["level"] for r in live) == [0, 0, 2]  # eleven runs by threes
    before = sorted(map(str, rollup.candidates().collect()))
    rollup.add(spark.createDataFrame(everything[:5], SCHEMA), "run 2")  # a repeated batch
    assert sorted(map(str, rollup.candidates().collect())) == before
    batch = [r for rows in runs(30, 9) for r in rows if r[2] >= 11]
    got = rollup.add(spark.createDataFrame(batch, SCHEMA), "many")
    want = ledger.new_or_known(spark.createDataFrame(everything + batch, SCHEMA), ["source_id", "url"], "run_id").where("run_id >= 11")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_run_reads_the_buckets_of_its_own_keys(spark, tmp_path):
    from sparkloom.operators.incremental import Rollup

    rollup = Rollup(spark, str(tmp_path / "r"), ["url"])
    rollup.add(spark.range(5000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(1).cast("long").alias("run_id"), F.lit("x").alias("at")), "one")
    small = spark.createDataFrame([("u7", 2, "y"), ("new", 2, "y")], "url string, run_id long, at string")
    assert len(rollup.touched(small)) <= 2
    got = rollup.add(small, "two")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    assert {r["url"]: r["classification"] for r in got.collect()} == {"u7": "known", "new": "new"}


def test_an_append_reads_no_stored_body_without_an_equal_path(spark, tmp_path):
    import pytest

    from sparkloom.operators import store

    state = store.State(spark, str(tmp_path / "s"))
    bodies = lambda *x: store.addressed(spark.createDataFrame([(b.encode(),) for b in x], "body binary"))
    store.store_exact(state, "objects", bodies("a", "b"))
    plan = store.held_paths(state.read("objects"), bodies("c"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan and "struct<path:string,body" not in plan
    store.store_exact(state, "objects", bodies("b", "c"))
    assert state.read("objects").count() == 3
    path = bodies("a").first()["path"]
    state.append("objects", spark.createDataFrame([(bodies("d").first()["path"], b"other")], "path string, body binary"))
    with pytest.raises(store.StateError, match="other bytes"):
        store.store_exact(state, "objects", bodies("d"))
    assert state.read("objects").where(F.col("path") == path).count() == 1
