"""Licence scans, in DataFrame expressions alone.

A template is a short licence text. Each text is cut into overlapping windows that are a little longer
than a template (in words) and advance by a quarter of it; MinHash bands of a window's shingles retrieve
templates, and the exact share of the template's shingles that the whole text holds verifies a match.

Windows come in lengths that grow by half, so that templates of all lengths need few of them. A band is
one minimum: a window of similarity J to a template retrieves it with probability 1 - (1 - J)^BANDS,
0.9988 for J = 0.1 and 64 bands. A window over an unchanged occurrence has J of 0.4 or more where it lies
best; a text that holds three quarters of a template in several places has windows of 0.1 or more unless
they are ten or so, and each place has windows of its own. Windows that share no shingle with a
template never retrieve it.

Texts and windows without any of a template's necessary words are put aside: where a share of 0.75
of a template's shingles is, one of the words that together stand in more than a quarter of them
must be. That drops no match.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import saved

WORDS, LEAST_SHARE = 5, 0.75
BANDS = 64
STEPS, SHORTEST, GROWTH = 4, 8, 1.5

#: Well-known licence notices and grants by their SPDX names.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "MIT-line": "Released under the MIT License.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License.",
}


def _tokens(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def _shingles(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + WORDS]) for i in range(len(words) - WORDS + 1)} if len(words) >= WORDS else {" ".join(words)}


def necessary_words(template: str) -> list[str]:
    """Words of which any text that holds LEAST_SHARE of the template's shingles has at least one: the rarest-looking such."""
    shingles = [x.split() for x in _shingles(_tokens(template))]
    chosen, missed = [], shingles
    for word in sorted({w for s in shingles for w in s}, key=lambda w: (-len(w), w)):
        if len(missed) < len(shingles) * LEAST_SHARE:
            break
        chosen.append(word)
        missed = [s for s in missed if word not in s]
    return chosen


def window_length(words: int) -> int:
    """The shortest of the window lengths that covers a template of so many words."""
    length = SHORTEST
    while length < words:
        length = math.ceil(length * GROWTH)
    return length


def _bands(shingles: Column) -> Column:
    """Keys of BANDS bands, each the least of one hash of an array of strings."""
    least = lambda b: F.array_min(F.transform(shingles, lambda x: F.xxhash64(b, x)))
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, least(b)))


def _windows(words: Column, length: Column) -> Column:
    """Windows of so many words, a quarter of that apart; the last one ends with the text."""
    last = F.greatest(F.size(words) - length, F.lit(0))
    starts = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.greatest(F.expr(f"kind.length div {STEPS}"), F.lit(1)).cast("int")), F.array(last)))
    return F.transform(starts, lambda a: F.slice(words, a + 1, length))


def _shingled(words: Column, size: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, size), " "))


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, license, n_held, n_shingles, share, start_word``: a row for each document and template of which it holds LEAST_SHARE or more.

    Words are runs of a-z and 0-9 of the lower-cased text. n_held counts the template's distinct
    shingles (five words; a shorter template is one shingle of its length) that stand anywhere in the
    text, n_shingles all of them, share is their ratio; start_word is the place of the first that the
    text holds. Null texts and texts without words hold nothing; repeated rows of an id and text are
    one document; rows with a null id, and texts under one id, are scanned each; several templates
    may be found in a text, equal ones each; other columns are ignored; an empty table or no
    templates give an empty result.
    """
    spark = docs.sparkSession
    known = [(name, words := _tokens(text), min(len(words), WORDS), window_length(len(words))) for name, text in templates.items()]
    asked = {name: necessary_words(text) for name, text in templates.items()}
    kinds: dict[tuple[int, int], set[str]] = {}
    for name, _, size, length in known:
        kinds.setdefault((length, size), set()).update(asked[name])

    lower = F.lower(F.col(f"`{text_col}`"))
    needed = "|".join(sorted({w for ws in asked.values() for w in ws}, key=lambda w: (-len(w), w))) or "(?!)"
    rows = docs.where(lower.rlike(needed))
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text_col}`").alias("h"), F.split(F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " ")), " ").alias("words")).distinct()
    rows, _ = saved(rows, "licensed")

    kind = "array<struct<length:int,size:int,needed:array<string>>>"
    all_kinds = F.from_json(F.lit(json.dumps([{"length": n, "size": size, "needed": sorted(ws)} for (n, size), ws in sorted(kinds.items())])), kind)
    cut = rows.select("doc_id", "h", "words", F.explode(F.filter(all_kinds, lambda k: F.arrays_overlap("words", k["needed"]))).alias("kind"))
    cut = cut.select("doc_id", "h", "kind", F.explode(_windows(F.col("words"), F.col("kind.length"))).alias("w")).where(F.arrays_overlap("w", "kind.needed"))
    cut = cut.select("doc_id", "h", "kind.size", F.col("kind.length").alias("length"), _shingled(F.col("w"), F.col("kind.size")).alias("shingles"))
    banded = cut.select("doc_id", "h", "size", "length", F.explode(_bands(F.col("shingles"))).alias("band"))

    schema = "license string, size int, length int, wanted array<string>"
    sets = spark.createDataFrame([(name, size, length, sorted(_shingles(words))) for name, words, size, length in known], schema)
    keys = sets.select("license", "size", "length", F.explode(_bands(F.col("wanted"))).alias("band"))
    found = banded.join(F.broadcast(keys), ["size", "length", "band"]).select("doc_id", "h", "license").distinct()

    texts = rows.select(F.col("doc_id").alias("i"), F.col("h").alias("t"), "words")
    whole = found.join(F.broadcast(sets), "license").join(texts, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("t")))
    whole = whole.select("doc_id", "license", "wanted", _shingled(F.col("words"), F.col("size")).alias("own"))
    held = F.size(F.array_intersect("wanted", "own")).cast("long")
    first = F.array_min(F.transform(F.filter(F.transform("wanted", lambda x: F.array_position("own", x)), lambda p: p > 0), lambda p: p - 1))
    out = whole.select("doc_id", "license", held.alias("n_held"), F.size("wanted").cast("long").alias("n_shingles"), first.cast("long").alias("start_word"))
    return out.where(F.col("n_held") >= LEAST_SHARE * F.col("n_shingles")).select("doc_id", "license", "n_held", "n_shingles", (F.col("n_held") / F.col("n_shingles")).alias("share"), "start_word")
