"""Removal of repeated byte strings against all strings of 400 bytes."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tests.llm.test_against_brute_force import documents, frame, odd_rows, same  # noqa: F401


def rows():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(90) for _ in range(6)]
    out = odd_rows()
    for i in range(120):  # passages with borders of their own, some altered, some cut short
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            p = p[a : a + rng.choice([398, 399, 400, 401, 450, 999])]
            if rng.random() < 0.3:
                k = rng.randrange(len(p))
                p = p[:k] + "X" + p[k + 1 :]
            parts += [p, prose(rng.randint(0, 30))]
        out.append((1000 + i, "".join(parts)))
    out += [(2000, "ab" * 700), (2001, "y" * 399), (2002, "y" * 400), (2003, "y" * 401), (2004, passages[0] + "|" + passages[0]), (2005, "\x00" * 900), (2006, "é" * 333)]
    return out + out[90:95] + [(None, out[100][1]), (3000, out[100][1])]


def test_repeats(spark, documents):  # noqa: F811
    from sparkloom.llm.repeats import repeat_digests

    for some in (rows(), documents):
        same(repeat_digests(frame(spark, some)), brute.repeats(some))
    assert repeat_digests(frame(spark, [])).count() == 0


def test_repeats_of_very_many_differing_phrases(spark, monkeypatch):
    from sparkloom.llm import repeats

    monkeypatch.setattr(repeats, "HOT", 3)
    same(repeats.repeat_digests(frame(spark, rows()).repartition(5)), brute.repeats(rows()))


def test_spans_and_kept_bytes(spark):
    from sparkloom.llm.repeats import remove_repeats

    docs = [(1, "a" + "0123456789" * 10 + "".join(map(chr, range(200, 400))) + "b"), (2, "c" + "0123456789" * 10 + "".join(map(chr, range(200, 400))) + "d"), (3, "short")]
    got = {r["doc_id"]: r for r in remove_repeats(frame(spark, docs)).collect()}
    assert [tuple(x) for x in got[1]["spans"]] == [(1, 501)] and bytes(got[1]["kept"]) == b"ab" and bytes(got[2]["kept"]) == b"cd"
    assert got[3]["spans"] == [] and got[3]["kept"] is None


@pytest.mark.parametrize("block", [271, 1000, 1 << 14])
def test_phrases_cover_every_start_once_and_alike(block, monkeypatch):
    from sparkloom.llm import repeats

    monkeypatch.setattr(repeats, "_BLOCK", block)
    rng = random.Random(2)
    passage = bytes(rng.randrange(256) for _ in range(3000))
    texts = [passage, b"z" * 700, b"q" + passage[5:], passage[:400], b"z" * 5000]
    buffer, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
    x, first, last = repeats._phrases(buffer, ends)
    starts = np.concatenate([np.arange(a, b) for a, b in zip(first, last + 1, strict=True)])
    assert starts.tolist() == [i for e, t in zip(ends.tolist(), texts, strict=True) for i in range(e - len(t), e - 399)]
    trigger = dict(zip(starts.tolist(), np.repeat(x, last - first + 1).tolist(), strict=True))
    at = len(passage) + 700 + 1
    assert all(trigger[i + 5] - i - 5 == trigger[at + i] - at - i for i in range(2995 - 400 + 1))
    assert ((x >= last) & (x - first < repeats.WINDOW)).all()
