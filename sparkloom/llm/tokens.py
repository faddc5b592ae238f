"""Encoding of whole texts with a public tokenizer, each distinct piece of a group of texts once.

The tokenizers library makes every id. Its pre-tokenizers never join what stands on both sides of
the places where a text is cut here (before a space or a line break that is not in the midst of
white space, and between Latin letters and the punctuation after them), so the ids of the pieces
are the ids of the text. Arrow splits the texts of a group and numbers its distinct pieces, which
are encoded together, with a separator between them whose id no piece can have; numpy puts the ids
of the texts together. A worker keeps the ids of at most KEPT_WORDS repeated pieces from one group to
the next: they are what the library gave, so results don't depend on what is kept. Where a tokenizer's file says that it ignores case, texts are lower-cased
before, and pieces of lower-case letters alone go to its model without the steps that leave such
pieces as they are. Memory is bounded by a group and the kept pieces.
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a group (or one batch, if that is larger); pieces encoded by one call.
GROUP_BYTES, CALL_PIECES = 4 << 20, 10_000
#: Pieces whose ids a worker keeps, and the longest of them in bytes.
KEPT_WORDS, KEPT_BYTES = 300_000, 40
#: White space on which Arrow and the tokenizers' patterns may differ, and the signs; such texts are encoded whole.
_ODD = "[\x01\x02\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]"
#: A space or line break in the midst or at the end of white space, before which no text may be cut.
_AMID = r"|[\t\n\r ][ \n](?:[\t\n\r ]|$)"
#: Marks between a Latin letter and a space; words come back less often with marks than without. In lower case
#: a capital I with a dot ends in a combining mark, which joins the marks.
_MARKED = "([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-ɏ])([-!-&(-,./:-@\\[-`{-~]+[ \n])"

#: Words of letters alone, of which none joins its neighbours, and marks that may join an ASCII letter in one case alone.
_LOWER_LETTERS, _LETTERS, _COMBINING = "^[a-zß-öø-ÿ]+$", "^[A-Za-zÀ-ÖØ-öø-ÿ]+$", "|[\u0300-\u036f]"
#: The steps of tokenizers that ignore case and take runs of letters as words, and of those that keep all.
_CASELESS = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORDS = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def _byte_alphabet() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes that aren't printing Latin-1 signs: the next ones from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}


_ALPHABET = _byte_alphabet()
_SPACE, _BREAK = _ALPHABET[0x20], _ALPHABET[0x0A]


class _Letters:
    """Words of letters alone: spelled in the byte alphabet they go to the tokenizer's model itself, as its steps would give them."""

    def __init__(self, made, spaced: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.words, self._spaced = _LETTERS if spaced else _LOWER_LETTERS, spaced
        self._made = Tokenizer(made.model)
        self._made.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = made.get_vocab(with_added_tokens=False)
        self._closing = np.zeros(max(vocabulary.values()) + 1, bool)
        suffix = made.model.end_of_word_suffix
        self._closing[[i for t, i in vocabulary.items() if (t == _BREAK if spaced else suffix and t.endswith(suffix))]] = True

    @classmethod
    def of(cls, made, path: str, spaced: bool) -> _Letters | None:
        """For tokenizers that have one of the known sequences of steps, with a sign or an ending that tells words apart."""
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        if spaced:
            known = steps["normalizer"] is None and steps["pre_tokenizer"] == _BYTES | {"use_regex": True}
        else:
            known = steps["normalizer"] == _CASELESS and steps["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [_WORDS, _BYTES]}
        made = cls(made, spaced) if known and steps["model"]["type"] == "BPE" else None
        return made if made is not None and made._closing.any() else None

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of words (after a space, if spaces count), and where those of each start and end; None if words can't be told apart."""
        runs, size, starts, ends = [], 0, np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        between = f" {_BREAK} {_SPACE}" if self._spaced else " "
        for at in range(0, len(words), CALL_PIECES):
            part = words.slice(at, CALL_PIECES)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), " ")[0].as_py()
            spelled = joined.encode().decode("latin-1")
            for byte in range(0x80, 0x100):
                if byte in _ALPHABET:
                    spelled = spelled.replace(chr(byte), _ALPHABET[byte])
            spelled = spelled.replace(" ", between)
            spelled = f"{_SPACE}{spelled} {_BREAK}" if self._spaced else spelled
            ids = np.array(self._made.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self._closing[ids])
            if len(last) != len(part):
                return None
            starts[at : at + len(part)] = size + np.append(0, last[:-1] + 1)
            ends[at : at + len(part)] = size + last + (not self._spaced)
            runs.append(ids)
            size += len(ids)
        return np.concatenate(runs) if runs else np.empty(0, "<u4"), starts, ends


class Encoder:
    """``spaced``: white space counts (byte-level vocabularies); otherwise it only separates."""

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._made = Tokenizer.from_file(path)
        self._made.encode_special_tokens = True
        self._spaced = spaced
        self._between = "\n" if spaced else " \x01 "
        mark = self._whole(self._between)
        self._mark = int(mark[0]) if len(mark) == 1 else None
        self._letters = _Letters.of(self._made, path, spaced)
        self._kept = pa.array([], pa.string())
        self._kept_ids, self._kept_starts, self._kept_ends = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    @staticmethod
    def of(path: str, spaced: bool) -> Encoder:
        """This worker's encoder: workers serve many tasks, and the vocabulary is read once."""
        held = sys.modules.setdefault("_sparkloom_worker", types.ModuleType("_sparkloom_worker")).__dict__
        if (path, spaced) not in held:
            held[path, spaced] = Encoder(path, spaced)
        return held[path, spaced]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._made.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _together(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The ids of pieces with a mark before each, and where each piece starts and ends."""
        text = self._between + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), self._between)[0].as_py()
        ids = self._whole(text)
        at = np.flatnonzero(ids == self._mark)
        return (ids, at + 1, np.append(at[1:], len(ids))) if len(at) == len(pieces) else None

    def _encoded(self, pieces: pa.Array, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each piece start and end; a mark stands before pieces that are not alone."""
        starts, ends = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        runs, size = [np.array([self._mark or 0], "<u4")], 1
        many = np.flatnonzero(~alone)
        for at in np.split(many, range(CALL_PIECES, len(many), CALL_PIECES)) if len(many) else []:
            made = self._together(pieces.take(pa.array(at)))
            if made is None:
                alone[at] = True
                continue
            starts[at], ends[at] = made[1] + size, made[2] + size
            runs.append(made[0])
            size += len(made[0])
        for k in np.flatnonzero(alone).tolist():
            ids = self._whole(pieces[k].as_py())
            starts[k], ends[k] = size + 1, size + 1 + len(ids)
            runs += [runs[0], ids]
            size += 1 + len(ids)
        return np.concatenate(runs), starts, ends

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct words: ids, and where those of each start and end."""
        at, made = np.empty(0, np.int64), None
        if self._letters is not None:
            plain = pc.match_substring_regex(words, self._letters.words).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(plain)
            made = self._letters.encoded(words.take(pa.array(at)))
        if made is None:
            return self._others(words)
        rest = np.flatnonzero(~plain)
        ids, first, last = self._others(words.take(pa.array(rest)))
        starts, ends = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        starts[rest], ends[rest] = first, last
        starts[at], ends[at] = made[1] + len(ids), made[2] + len(ids)
        return np.concatenate([ids, made[0]]), starts, ends

    def _others(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As _pieces(), by all of the tokenizer's steps."""
        blank = pc.equal(words, "").to_numpy(zero_copy_only=False)
        if not self._spaced:
            ids, starts, ends = self._encoded(words, np.full(len(words), self._mark is None))
            return ids, starts, np.where(blank, starts, ends)
        first, broken = (pc.starts_with(words, x) for x in ("\x02", "\x01"))
        bare = pc.utf8_slice_codeunits(words, 1)
        inner = pc.match_substring_regex(words, r"[\t\r]")
        spelled = pc.if_else(pc.and_(broken, inner), pc.binary_join_element_wise("\n", bare, ""), pc.if_else(pc.or_(first, broken), bare, pc.binary_join_element_wise(" ", words, "")))
        inner, broken = inner.to_numpy(zero_copy_only=False), broken.to_numpy(zero_copy_only=False)
        empty = pc.equal(spelled, "").to_numpy(zero_copy_only=False)
        ids, starts, ends = self._encoded(spelled, blank | inner | empty | (self._mark is None))
        starts[broken & ~inner] -= 1
        return ids, starts, ends

    def _known_pieces(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As _pieces(), but only words that aren't kept are encoded; repeated ones are kept."""
        at = pc.fill_null(pc.index_in(words, value_set=self._kept), -1).to_numpy(zero_copy_only=False)
        new, old = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        made, first, last = self._pieces(words.take(pa.array(new)))
        ids, starts, ends = np.concatenate([self._kept_ids, made]), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        starts[new], ends[new] = first + len(self._kept_ids), last + len(self._kept_ids)
        starts[old], ends[old] = self._kept_starts[at[old]], self._kept_ends[at[old]]
        short = pc.less_equal(pc.binary_length(words), KEPT_BYTES).to_numpy(zero_copy_only=False)
        fresh = new[(counts[new] > 1) & short[new]]
        if len(fresh):
            self._keep(words, counts, old, fresh, ids, starts, ends)
        return ids, starts, ends

    def _keep(self, words: pa.Array, counts: np.ndarray, old: np.ndarray, fresh: np.ndarray, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Adds fresh words to the kept ones; when they would be too many, only this group's most frequent ones stay."""
        if len(self._kept) + len(fresh) > KEPT_WORDS:
            fresh = np.append(old, fresh)
            fresh = fresh[np.argsort(-counts[fresh], kind="stable")[:KEPT_WORDS]]
            self._kept, self._kept_ids, self._kept_starts, self._kept_ends = self._kept[:0], self._kept_ids[:0], self._kept_starts[:0], self._kept_ends[:0]
        n = ends[fresh] - starts[fresh]
        upto = np.cumsum(n) + len(self._kept_ids)
        own = ids[np.repeat(starts[fresh] - (upto - n), n) + np.arange(len(self._kept_ids), len(self._kept_ids) + n.sum())]
        self._kept = pa.concat_arrays([self._kept, words.take(pa.array(fresh))])
        self._kept_ids = np.concatenate([self._kept_ids, own])
        self._kept_starts, self._kept_ends = np.append(self._kept_starts, upto - n), np.append(self._kept_ends, upto)

    def _joined(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that can be cut, and the bounds of each text's ids.

        A piece follows a space, or, if it starts with a sign, a line break (1) or nothing (2).
        """
        if self._spaced:
            texts = pc.binary_join_element_wise("\x02", pc.replace_substring(texts, "\n", " \x01"), "")
        if self._letters is not None and not self._spaced:
            texts = pc.ascii_lower(texts)
        texts = pc.replace_substring_regex(texts, _MARKED, "\\1 \x02\\2" if self._spaced else "\\1 \\2")
        split = pc.split_pattern(texts, " ") if self._spaced else pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        ids, starts, ends = self._known_pieces(coded.dictionary, np.bincount(at, minlength=len(coded.dictionary)))
        n = (ends - starts).astype(np.int32)[at]
        upto = np.cumsum(n, dtype=np.int32)
        before = starts.astype(np.int32)[at]
        before -= upto
        before += n
        places = np.repeat(before, n)
        places += np.arange(len(places), dtype=np.int32)
        of_text = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy()))
        return ids[places], np.append(np.int32(0), upto)[of_text].astype(np.int64)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; none for null."""
        apart = pc.fill_null(pc.match_substring_regex(texts, _ODD + _AMID * self._spaced + _COMBINING * (self._letters is not None and not self._spaced)), False)
        ids, bounds = self._joined(pc.replace_with_mask(texts, apart, pa.scalar(None, pa.string())))
        raw, ends = ids.data.cast("B"), (4 * bounds).tolist()
        out = [bytes(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for k in np.flatnonzero(apart.to_numpy(zero_copy_only=False)).tolist():
            out[k] = self._whole(texts[k].as_py()).tobytes()
        return out

    def groups(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
        """For batches of (id, text): the ids of many rows, and each row's token ids."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(1).nbytes
            if size >= GROUP_BYTES:
                yield self._group(held)
                size = 0
        if held:
            yield self._group(held)

    def _group(self, batches: list[pa.RecordBatch]) -> tuple[pa.Array, list[bytes]]:
        ids, texts = (pa.concat_arrays([b.column(c) for b in batches]) for c in (0, 1))
        batches.clear()
        return ids, self.encode(texts)
