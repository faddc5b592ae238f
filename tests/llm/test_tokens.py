"""Texts cut into pieces against texts encoded whole, on odd white space, marks, signs and special tokens."""

import random

import numpy as np
import pyarrow as pa
import pytest

from sparkloom.llm import tokens
from sparkloom.llm.queries import tokenizer_path

PARTS = ["a", "b", "The", "é", "ß", "'s", "don't", " ", " ", "  ", "   ", "\n", "\n\n", " \n", "\n ", "\t", "\r", "\r\n", ".", ",", "!", "?", "1", "42", "-", "_", "中", "文", "🙂", "\x00", "\x01", "\x02", "\x0b", "\x1c", "\x85", "\xa0", "​", "<unk>", "[SEP]", "<|endoftext|>", "</s>", "x" * 60]
PARTS += ["H", "h", "I", "J", "\u0331", "\u0307", "\u030c", "É", "ß", "İ", "\u212a", "Straße ", "élan, ", "÷", "ª"]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@pytest.mark.parametrize("pieces", [10_000, 7])
def test_pieces_give_the_ids_of_whole_texts(monkeypatch, name, spaced, pieces):
    monkeypatch.setattr(tokens, "CALL_PIECES", pieces)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 20_000)
    rng = random.Random(pieces)
    texts = [None, "", " ", *("".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(6000)), None]
    made = tokens.Encoder(tokenizer_path(name), spaced)
    batches = [pa.record_batch([pa.array(range(i, i + len(t := texts[i : i + 500]))), pa.array(t, pa.string())], ["id", "t"]) for i in range(0, len(texts), 500)]
    found = [(i, x) for ids, group in made.groups(batches) for i, x in zip(ids.to_pylist(), group, strict=True)]
    whole = made._made.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    assert [i for i, _ in found] == list(range(len(texts)))
    assert [np.frombuffer(x, "<u4").tolist() for _, x in found] == [x.ids for x in whole]
    assert list(made.groups([])) == []
    empty = pa.record_batch([pa.array([], pa.int64()), pa.array([], pa.string())], ["id", "t"])
    assert [(len(i), x) for i, x in made.groups([empty])] == [(0, [])]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_slice_of_an_array(name, spaced):
    texts = ["à b", None, "odd\u2003space", "ça va, et là. ", "Die Größe", "", None, "fin \x85 ."] * 9
    made = tokens.Encoder(tokenizer_path(name), spaced)
    assert made.encode(pa.array(texts).slice(5, 40)) == made.encode(pa.array(texts[5:45]))
