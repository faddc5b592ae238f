"""Information-theoretic sanitisation, in DataFrame expressions alone.

Patterns find direct identifiers (mail, ip, card and phone numbers), each a protected entity. The
corpus then tells which words of an entity's documents give it away: with N documents, n(t) with
word t, n(e) with entity e and n(t, e) with both, a word discloses the share

    log2(N n(t, e) / (n(t) n(e))) / log2(N / n(e))

of the entity's information (1: the word occurs only with it; 0: independent). From GENERALISE on
a word is replaced by its kind, from REMOVE on it is removed, at all its places in the documents
that hold that entity. Fewer than SUPPORT documents are no evidence, nor are so few that a word of no
bearing would have all of them among the entity's by more than CHANCE: (n(e) / N) ** n(t, e). Every
entity is weighed by this; one that all documents hold carries no information, and so no word can.

A mail address protects its domain too, since it names an organisation.

Entities are counted first; only the texts that hold one of SUPPORT documents or more are cut into
words by entity, and counts are shuffled after partial aggregation. The patterns are the contract's,
with possessive repetition and a look behind in place of hopeless starts within a run, so that they
match the same but in linear time. Places are running sums of lengths, taken in blocks of the square
root of their number, and texts are rebuilt from blocks of BLOCK_CHARS, so that a text of very many
matches costs little more than its length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.arrays import let, running
from sparkloom.llm.common import discard, listed, saved

SUPPORT, GENERALISE, REMOVE, CHANCE = 3, 0.8, 0.95, 0.001
#: Characters of the blocks that a text is cut into to be rebuilt.
BLOCK_CHARS = 1024
#: Rows, and edits of texts, that are broadcast at most.
BROADCAST_IDS, BROADCAST_EDITS = 2_000_000, 1_000_000
KINDS = ("email", "ip", "card", "phone")

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Without these a text has no match of the kind that counts.
_NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_WORD = r"\p{L}{3,}"
_SPAN = "struct<kind:string,start:int,end:int>"


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        doubled = lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
        each = F.transform(F.split(F.reverse(digits), ""), lambda x, i: doubled(F.coalesce(x.try_cast("int"), F.lit(0)), i))
        luhn = F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0
        return F.when(F.length(digits).between(16, 19), luhn).otherwise(False)
    return F.lit(True)


def _matches(text: Column, pattern: str, made) -> Column:
    """made(match, start) for each match of pattern in text."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))

    def placed(zipped: Column) -> Column:
        ends = running(F.transform(zipped, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))), F.lit(0), lambda at, n: at + n)
        both = F.zip_with(zipped, ends, lambda x, at: F.struct(x["match"].alias("match"), (at + F.length(x["gap"])).alias("start")))
        return F.transform(F.filter(both, lambda x: x["match"].isNotNull()), lambda x: made(x["match"], x["start"]))

    return let(parts, placed)


def _found(kind: str, text: Column) -> Column:
    """``spans`` and the distinct ``values`` that are entities in them."""
    one = lambda m, at: F.struct(F.struct(F.lit(kind).alias("kind"), at.alias("start"), (at + F.length(m)).alias("end")).alias("span"), F.lower(m).alias("value"), F.coalesce(_valid(kind, m), F.lit(False)).alias("ok"))
    value = lambda x: x["value"]
    entities = lambda good: F.transform(good, value)
    if kind == "email":
        entities = lambda good: F.concat(F.transform(good, value), F.transform(good, lambda x: F.concat(F.lit("@"), F.substring_index(x["value"], "@", -1))))
    whole = let(F.filter(_matches(text, PATTERNS[kind], one), lambda x: x["ok"]), lambda good: F.struct(F.transform(good, lambda x: x["span"].cast(_SPAN)).alias("spans"), F.array_distinct(entities(good)).alias("values")))
    none = F.struct(F.array().cast(f"array<{_SPAN}>").alias("spans"), F.array().cast("array<string>").alias("values"))
    return F.when(text.rlike(_NEEDED[kind]), whole).otherwise(none)


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, t, base, values`` for each row: the direct identifiers by kind and start, and the distinct values of them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t"), *[_found(k, text).alias(k) for k in KINDS])
    return rows.select("id", "t", F.concat(*[F.col(f"{k}.spans") for k in KINDS]).alias("base"), F.array_distinct(F.concat(*[F.col(f"{k}.values") for k in KINDS])).alias("values"))


def _words(text: Column) -> Column:
    """The words of a text, with their places."""
    one = lambda m, at: F.struct(F.lower(m).alias("word"), at.alias("start"), (at + F.length(m)).alias("end"))
    return _matches(text, rf"(?<!\p{{L}}){_WORD}+", one)


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(F.split(text, r"\P{L}+"), lambda w: F.length(w) >= 3), F.lower))


def _few(df: DataFrame) -> DataFrame:
    return listed(df, BROADCAST_IDS)


def disclosing_terms(docs: DataFrame, base: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(``id, t, text, values``: rows that hold entities with support; ``value, word, share``: the disclosing words)."""
    n = base.count()
    entity = base.where(F.size("values") > 0).select(F.explode("values").alias("value"))
    entities, entities_path = saved(entity.groupBy("value").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= SUPPORT), "entities")
    holders = base.where(F.size("values") > 0).select("id", "t", F.explode("values").alias("value")).distinct().join(_few(entities), "value")
    holders, holders_path = saved(holders.groupBy("id", "t").agg(F.collect_list("value").alias("values")), "holders")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))
    named = _few(holders.select(F.col("id").alias("_i"), F.col("t").alias("_h"), "values"))
    held, _ = saved(rows.join(named, F.col("id").eqNullSafe(F.col("_i")) & (F.col("t") == F.col("_h"))).select("id", "t", "text", "values"), "held")

    own = held.select("values", F.explode(_distinct_words(F.col("text"))).alias("word")).select(F.explode("values").alias("value"), "word")
    once = own.groupBy("value", "word").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= SUPPORT)
    telling = F.col("n_te") * F.log2(F.lit(float(n)) / F.col("n_e")) >= -math.log2(CHANCE) - 1e-9
    pairs, pairs_path = saved(once.join(_few(entities), "value").where(telling), "pairs")
    seen = docs.where(F.col(text_col).isNotNull()).select(F.explode(_distinct_words(F.col(text_col))).alias("word"))
    wanted = _few(pairs.select("word").distinct())
    seen = seen.join(wanted, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n_t"))
    share = F.log2(F.lit(float(n)) * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / F.log2(F.lit(float(n)) / F.col("n_e"))
    terms = pairs.join(seen, "word").select("value", "word", share.alias("share")).where(F.col("share") >= GENERALISE)
    terms, _ = saved(terms, "terms")
    discard(docs.sparkSession, entities_path, holders_path, pairs_path)
    return held, terms


def term_spans(docs: DataFrame, base: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, t, terms``: the disclosing words of each document that has any, by place, with their shares.

    Words inside an identifier, which is replaced as a whole, are left out.
    """
    held, terms = disclosing_terms(docs, base, id_col, text_col)
    rows = held.dropDuplicates(["id", "t"])
    own = rows.select("id", "t", "values", F.explode(_distinct_words(F.col("text"))).alias("word")).select("id", "t", F.explode("values").alias("value"), "word")
    hit = own.join(_few(terms), ["value", "word"]).groupBy("id", "t", "word").agg(F.max("share").alias("share"))
    placed = rows.select("id", "t", F.explode(_words(F.col("text"))).alias("w")).select(F.col("id").alias("_i"), F.col("t").alias("_h"), "w.word", "w.start", "w.end")
    found = placed.join(hit.withColumnRenamed("word", "_w"), F.col("id").eqNullSafe(F.col("_i")) & (F.col("t") == F.col("_h")) & (F.col("word") == F.col("_w")))
    spans = base.select(F.col("id").alias("_i"), F.col("t").alias("_h"), "base").dropDuplicates(["_i", "_h"])
    found = found.select("id", "t", "start", "end", "share").groupBy("id", "t").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    inside = lambda w: F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))
    found = found.join(spans, F.col("id").eqNullSafe(F.col("_i")) & (F.col("t") == F.col("_h"))).select("id", "t", F.filter("terms", lambda w: ~inside(w)).alias("terms"))
    return found.where(F.size("terms") > 0)


def _with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    named = terms.select(F.col("id").alias("_i"), F.col("t").alias("_h"), "terms")
    return rows.join(named, (F.col("id").eqNullSafe(F.col("_i"))) & (F.col("t") == F.col("_h")), "left").drop("_i", "_h")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for each row.

    Null and empty texts have no spans (base_sha256 is that of the empty string). Places are code
    points, end exclusive; kinds are found independently and may overlap. Repeated rows count as
    so many documents and give equal rows; null ids take part; other columns are ignored.
    """
    base, _ = saved(base_spans(docs, id_col, text_col), "base")
    rows = _with_terms(base, term_spans(docs, base, id_col, text_col))
    joined = F.array_join(F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    terms = F.array_join(F.transform(F.coalesce("terms", F.array()), lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    all_spans = F.when(terms == "", joined).when(joined == "", terms).otherwise(F.concat(joined, F.lit(","), terms))
    return rows.select(F.col("id").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(joined, 256).alias("base_sha256"), all_spans.alias("spans"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with all columns, identifiers replaced by their kind, disclosing words generalised or removed.

    Overlapping spans are replaced by one mark. Null texts stay null.
    """
    base, _ = saved(base_spans(docs, id_col, text_col), "base")
    marks = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("mark")))
    words = F.transform(F.coalesce("terms", F.array()), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= REMOVE, "").otherwise("[TERM]").alias("mark")))
    edits = _with_terms(base.select("id", "t", "base"), term_spans(docs, base, id_col, text_col)).select(F.col("id").alias("i"), F.col("t").alias("h"), F.array_sort(F.concat(marks, words)).alias("edits"))
    edits, _ = saved(edits.where(F.size("edits") > 0).groupBy("i", "h").agg(F.first("edits").alias("edits")), "edits")
    few = edits.agg(F.coalesce(F.sum(F.size("edits")), F.lit(0))).first()[0] <= BROADCAST_EDITS
    edits = F.broadcast(edits) if few else edits.hint("shuffle_hash")
    names, text = docs.columns, F.col("row.text")
    others = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names) if c != text_col]
    rows = docs.select(F.struct(F.col(f"`{text_col}`").alias("text"), *others).alias("row"), F.col(f"`{id_col}`").cast("long").alias("own"))
    rows = rows.withColumn("print", F.xxhash64(F.coalesce(text, F.lit(""))))
    rows = rows.join(edits, F.col("own").eqNullSafe(F.col("i")) & (F.col("print") == F.col("h")), "left")
    new = F.when(F.col("edits").isNull(), text).otherwise(_rewritten(text, F.col("edits")))
    return rows.withColumn("new", new).select(*[(F.col("new") if c == text_col else F.col(f"row.c{k}")).alias(c) for k, c in enumerate(names)])


def _rewritten(text: Column, edits: Column) -> Column:
    """text with the spans of the edits, which are in order, replaced by their marks; of overlapping spans the first counts and the rest goes."""
    size = F.lit(BLOCK_CHARS)

    def cut(blocks: Column, a: Column, b: Column) -> Column:
        """The characters from a to before b."""
        i, j = (F.floor(x / size).cast("int") for x in (a, b))
        first = F.substring(F.get(blocks, i), a % size + 1, F.when(i == j, b - a).otherwise(size))
        middle = F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), "")
        last = F.when(i == j, F.lit("")).otherwise(F.substring(F.get(blocks, j), F.lit(1), b % size))
        return F.concat(F.coalesce(first, F.lit("")), middle, F.coalesce(last, F.lit("")))

    def whole(blocks: Column, upto: Column) -> Column:
        """upto: where the text before each edit has been dealt with, and where the text after all is next."""
        piece = lambda e, at: F.when(e["start"] >= at, F.concat(cut(blocks, at, e["start"]), e["mark"])).otherwise(F.lit(""))
        pieces = F.zip_with(edits, F.slice(upto, F.lit(1), F.size(edits)), piece)
        return F.concat(F.array_join(pieces, ""), cut(blocks, F.element_at(upto, F.lit(-1)), F.length(text)))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    furthest = running(F.transform(edits, lambda e: e["end"]), F.lit(0), lambda at, end: F.greatest(at, end))
    return let(blocks, lambda b: let(furthest, lambda upto: whole(b, upto)))
