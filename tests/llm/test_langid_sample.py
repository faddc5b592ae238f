"""What the language classifier's sample takes in the driver."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np


def test_sample_is_fetched_as_arrays_not_as_numbers(spark, monkeypatch):
    from sparkloom.llm import langid

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(3000)]
    rows = [(i, "xy"[i % 2], " ".join(rng.choices(words, k=400))) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").localCheckpoint()
    got = {}
    monkeypatch.setattr(langid, "train", lambda rows, shuffled=(), seed=7: got.update(rows=rows, shuffled=shuffled))
    langid.fit(docs)  # what is imported and planned once isn't counted
    tracemalloc.start()
    langid.fit(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()

    values = sum(len(r[1]) for r in got["rows"]) + sum(len(x[0]) for x in got["shuffled"])
    assert len(got["rows"]) == len(rows) and values > 150_000
    assert peak < 8 * values + (1 << 20)  # a bucket and its count as 32-bit integers
    texts = {langid.features(t)[langid.features(t) > 0].tobytes() for _, _, t in rows}
    assert {np.asarray(n, np.int64).tobytes() for _, _, n in got["rows"]} == texts
