"""Language identification: averaged hashed subword embeddings and a linear softmax.

Letter n-grams are hashed to rows of an embedding table; a text is the mean of its rows, and a
linear layer with softmax names the language. Both are trained by stochastic gradient descent in
numpy, on a bounded sample of labelled documents. A part of the sample is kept from training to
calibrate the scores by temperature and to set the score under which a text is rejected.

A softmax is sure of texts that are in none of its languages. So the score is the chance of the
language times the text's familiarity, which falls with its surprise: how far the mean log
likelihood of its n-grams in that language lies under the usual one, less so for short texts. Where
it falls is set between calibration texts in their own language and texts from outside: the same
ones as if their language had not been learnt, and their letters shuffled.
"""

from __future__ import annotations

import random
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.llm.common import small_batches

#: The documented bounds of what the classifier is fitted on: rows of a language (expected), and in all.
SAMPLE_PER_LANGUAGE, SAMPLE_TOTAL = 800, 8_000
BUCKETS, DIMENSIONS, ORDERS = 1 << 14, 16, (1, 2, 3)
EPOCHS, RATE = 6, 0.5
#: How far, times the rate, one text may move its own mean embedding: what bounds the step of texts in which few n-grams prevail.
GAIN = 1.0
CALIBRATION_SHARE = 4  # one sampled document of so many
#: Share of well-labelled calibration documents that rejection may cost, and its least score.
REJECTED_SHARE, SURELY_KEPT = 0.005, 0.5
#: n-grams at which a text's surprise counts 0.7 times; fewer calibration texts than LEAST_HELD are no evidence.
SHORT, LEAST_HELD = 100, 20
#: Familiarity of the least familiar calibration text that is kept.
FAMILIAR = 0.95
UNDETERMINED = "und"
_STEP = 1 << 18


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as code points, runs of anything else as one 0."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = ((c >= 97) & (c <= 122)) | ((c >= 170) & (c != 215) & (c != 247) & ((c < 0x2000) | (c > 0x2BFF)) & ((c < 0xE000) | (c > 0xF8FF)) & (c < 0x1F000) | (c >= 0x20000))
    letter |= (c == 0xAA) | (c == 0xB5) | (c == 0xBA)
    letter &= ~((c >= 171) & (c <= 180) | (c >= 182) & (c <= 185) | (c >= 187) & (c <= 191))
    c = np.where(letter, c, 0)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    return c[keep]


def features(text: str | None) -> np.ndarray | None:
    """How often each bucket is hit by the n-grams of the whole text; None if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    counts = np.zeros(BUCKETS, np.int64)
    before = np.zeros(1, np.uint32)  # the last letters of the block before, so that a cut changes nothing
    for at in range(0, len(text), _STEP):
        own = _codes(text[at : at + _STEP])
        own = own[1:] if len(own) and own[0] == 0 == before[-1] else own
        c = np.concatenate([before, own, np.zeros(int(at + _STEP >= len(text)), np.uint32)]).astype(np.uint32)
        for n in ORDERS:
            g = c[max(0, len(before) - n + 1) :]
            if len(g) < n:
                continue
            h = np.full(len(g) - n + 1, n, np.uint32)
            for i in range(n):
                h = (h ^ g[i : i + len(h)]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            counts += np.bincount(h[g[(n - 1) // 2 : (n - 1) // 2 + len(h)] != 0] & np.uint32(BUCKETS - 1), minlength=BUCKETS)
        before = c[-(max(ORDERS) - 1) :]
    return counts


class Model:
    """Languages, embeddings, softmax weights, temperature, threshold, and the log likelihoods of the buckets seen in each language."""

    def __init__(self, languages: list[str], embedding: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.languages, self.embedding, self.weights, self.bias = languages, embedding, weights, bias
        self.temperature, self.threshold = 1.0, 0.0
        self.likely: list[tuple[np.ndarray, np.ndarray, float]] = []
        self.usual = np.zeros(len(languages))
        self.middle, self.slope = np.inf, 1.0

    def scores(self, counts: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(counts)
        z = (counts[at] @ self.embedding[at] / max(1, counts.sum()) @ self.weights + self.bias) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def surprise(self, at: np.ndarray, counts: np.ndarray, k: int) -> float:
        """How far the text's n-grams are from language k's, in nats a n-gram."""
        n = counts.sum()
        return float((self.usual[k] - self.mean_likelihood(at, counts, k)) * np.sqrt(n / (n + SHORT)))

    def mean_likelihood(self, at: np.ndarray, counts: np.ndarray, k: int) -> float:
        """The mean log likelihood of the text's n-grams in language k."""
        seen, logs, unseen = self.likely[k]
        place = np.minimum(np.searchsorted(seen, at), len(seen) - 1)
        return float(counts @ np.where(seen[place] == at, logs[place], unseen) / counts.sum())

    def learn_likelihoods(self, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        """From (language, buckets, counts) rows; every bucket counts a half more."""
        for k in range(len(self.languages)):
            seen = np.full(BUCKETS, 0.5)
            for y, at, n in rows:
                if y == k:
                    seen[at] += n
            own = np.flatnonzero(seen > 0.5)
            own = own if len(own) else np.zeros(1, np.int64)
            self.likely.append((own, np.log(seen[own] / seen.sum()), float(np.log(0.5 / seen.sum()))))

    def familiarity(self, counts: np.ndarray, k: int) -> float:
        if not np.isfinite(self.middle):
            return 1.0
        at = np.flatnonzero(counts)
        return float(1 / (1 + np.exp(np.clip(self.slope * (self.surprise(at, counts[at], k) - self.middle), -50, 50))))


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], shuffled: list[tuple[np.ndarray, np.ndarray]] = (), seed: int = 7) -> Model | None:
    """Fit on (language, buckets, counts) rows in a given order; None without rows. shuffled: texts in no language."""
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    held = [i for i in range(len(rows)) if i % CALIBRATION_SHARE == CALIBRATION_SHARE - 1]
    fit = [i for i in range(len(rows)) if i % CALIBRATION_SHARE != CALIBRATION_SHARE - 1]
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    w, b = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    y = [languages.index(r[0]) for r in rows]
    share = lambda i: rows[i][2] / rows[i][2].sum()
    steps, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            rate = RATE * (1 - done / steps)
            done += 1
            at, part = rows[i][1], share(i)
            mean = part @ e[at]
            z = mean @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = w @ p
            w -= rate * np.outer(mean, p)
            b -= rate * p
            e[at] -= rate * (part * min(len(at), GAIN / (part @ part)))[:, None] * back
    model = Model(languages, e, w, b)
    model.learn_likelihoods([(y[i], rows[i][1], rows[i][2]) for i in fit])
    _calibrate(model, [(y[i], rows[i][1], share(i), rows[i][2]) for i in held], list(shuffled))
    return model


def _calibrate(model: Model, held: list[tuple], shuffled: list[tuple]) -> None:
    """Temperature of least log loss, not under 1; familiarity; a threshold that keeps all but REJECTED_SHARE of right texts."""
    if not held:
        return
    z = np.array([part @ model.embedding[at] @ model.weights + model.bias for _, at, part, _ in held])
    y = np.array([h[0] for h in held])

    def chances(t: float) -> np.ndarray:
        p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    loss = {t: -np.log(chances(t)[np.arange(len(y)), y] + 1e-12).mean() for t in np.geomspace(1, 20, 60)}
    model.temperature = float(min(loss, key=loss.get))
    p = chances(model.temperature)
    ok = np.flatnonzero(p.argmax(axis=1) == y)
    _learn_outside(model, [held[i] for i in ok], z[ok], shuffled)
    own = np.array([model.familiarity(_dense(at, n), k) for k, at, _, n in held])
    right = np.sort((p.max(axis=1) * own)[ok])
    if len(right):
        model.threshold = float(min(SURELY_KEPT, right[int(REJECTED_SHARE * len(right))]))


def _dense(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    counts = np.zeros(BUCKETS)
    counts[at] = n
    return counts


def _learn_outside(model: Model, held: list[tuple], z: np.ndarray, shuffled: list[tuple]) -> None:
    """Where familiarity falls: amid the most surprising texts kept in their own language and the least surprising ones from outside."""
    if len(held) < LEAST_HELD:
        return
    mean = [model.mean_likelihood(at, n, k) for k, at, _, n in held]
    of = [[m for m, h in zip(mean, held, strict=True) if h[0] == k] for k in range(len(model.languages))]
    model.usual = np.array([np.median(x or mean) for x in of])
    inside = np.sort([model.surprise(at, n, k) for k, at, _, n in held])
    outside = [model.surprise(at, n, int(model.scores(_dense(at, n)).argmax())) for at, n in shuffled]
    if len(model.languages) > 1:
        for (k, at, _, n), others in zip(held, z.copy(), strict=True):
            others[k] = -np.inf
            outside.append(model.surprise(at, n, int(others.argmax())))
    kept = float(inside[-1 - int(REJECTED_SHARE * len(inside))])
    least = float(np.quantile(outside, 0.05)) if outside else kept
    model.middle = max(kept + 0.1, (kept + least) / 2)
    model.slope = float(np.log(FAMILIAR / (1 - FAMILIAR)) / (model.middle - kept))


def _shuffled(text: str) -> str:
    letters = list(text)
    random.Random(len(letters)).shuffle(letters)
    return "".join(letters)


def _sparse(batches):
    for batch in batches:
        made: dict[str, list] = {"at": [], "n": [], "mixed_at": [], "mixed_n": []}
        for h, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            for which, x in (("", text), ("mixed_", _shuffled(text) if h % CALIBRATION_SHARE == 0 else None)):
                counts = features(x)
                counts = np.zeros(1, np.int64) if counts is None else counts
                own = np.flatnonzero(counts)
                made[f"{which}at"].append(own.astype(np.int32)), made[f"{which}n"].append(counts[own].astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, pa.list_(pa.int32())) for x in made.values()]], ["h", "lang", *made])


def _arrays(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """Each list as a view of the fetched values: never as Python's numbers, which take nine times the memory and don't give it back."""
    out = []
    for chunk in lists.chunks:
        ends, values = chunk.offsets.to_numpy(), chunk.values.to_numpy()
        out += [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Train on a sample of labelled rows of docs: those with the smallest hashes of id and text.

    At most SAMPLE_PER_LANGUAGE documents of a language are expected, and SAMPLE_TOTAL at most in
    all; whole texts, as counts of buckets. Rows without id are told apart by their texts.
    """
    small_batches(docs.sparkSession)
    lang, text = F.col(f"`{lang_col}`"), F.col(f"`{text_col}`")
    labelled = docs.where(lang.isNotNull() & text.isNotNull())
    labelled = labelled.select(F.xxhash64(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), text).alias("h"), lang.alias("lang"), text.alias("t"))
    of = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    languages = of.count()
    if not languages:
        return None
    each = min(SAMPLE_PER_LANGUAGE, max(1, SAMPLE_TOTAL // languages))
    of = F.broadcast(of) if languages <= SAMPLE_TOTAL else of
    wanted = labelled.join(of, "lang").where(F.pmod("h", F.lit(1 << 30)) * F.col("n") < each * (1 << 30))
    sparse = wanted.select("h", "lang", "t").mapInArrow(_sparse, "h long, lang string, at array<int>, n array<int>, mixed_at array<int>, mixed_n array<int>")
    sample = sparse.orderBy("h", "lang", "at", "n").limit(SAMPLE_TOTAL).toArrow()
    own, mixed = (zip(_arrays(sample.column(f"{x}at")), _arrays(sample.column(f"{x}n")), strict=True) for x in ("", "mixed_"))
    return train([(lang, *x) for lang, x in zip(sample.column("lang").to_pylist(), own, strict=True)], [x for x in mixed if len(x[0])])


def _named(batches, model: Model | None, text_at: int | None = None):
    """Adds the predictions to the batches; the text is ``_t``, which goes, or a field of ``_row``, which stays."""
    for batch in batches:
        langs, scores, rejected = [], [], []
        for text in batch.column("_t") if text_at is None else batch.column("_row").field(text_at):
            text = text.as_py()
            counts = features(text)
            if model is None or counts is None:
                langs.append(UNDETERMINED), scores.append(0.0), rejected.append(True)
                continue
            p = model.scores(counts)
            k = int(p.argmax())
            score = float(p[k]) * model.familiarity(counts, k)
            langs.append(model.languages[k]), scores.append(score), rejected.append(score < model.threshold)
        made = {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()), "rejected": pa.array(rejected, pa.bool_())}
        rest = {n: batch.column(n) for n in batch.schema.names if n != "_t"}
        yield pa.RecordBatch.from_arrays([*rest.values(), *made.values()], [*rest, *made])


_ADDED = "lang_pred string, score double, rejected boolean"


def held_out(id_col: str = "doc_id"):
    """The fold that is never learnt from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for each row, learnt from the other fold.

    Null texts and texts without a letter are ``und`` with score 0 and rejected, as is every text
    if there is nothing to learn from; ties go to the first language by name. A null id is not
    held out. Repeated rows give repeated rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    model = fit(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("_t"))
    return rows.mapInArrow(partial(_named, model=model), f"doc_id long, held_out boolean, {_ADDED}")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language isn't rejected, with all their columns."""
    small_batches(docs.sparkSession)
    model = fit(docs.where(~held_out()))
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("_row")
    packed = docs.select(row)
    schema = StructType([*packed.schema, *StructType.fromDDL(_ADDED)])
    out = packed.mapInArrow(partial(_named, model=model, text_at=names.index("text")), schema)
    return out.where(~F.col("rejected")).select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)])
