"""Each operator against a plain restatement, on fixtures with nulls, ties, copies and long texts, and on sf0.001."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm import brute

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).withColumns({"n": F.lit(1), "k": F.lit("x"), "id": F.lit(2.5), "h": F.lit(3)})


def same(df, expected, columns=None):
    got = df.select(*(columns or df.columns)).collect()
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)


def odd_rows():
    rng = random.Random(5)
    words = [rng.choice("abcdefg") * rng.randint(1, 3) + rng.choice("xyzé") for _ in range(40)]
    base = [rng.choice(words) for _ in range(200)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One TWO"), (6, "a b c d e"), (None, "a b c d e"), (7, "!!! ... ???"), (7, "!!! ... ???"), (8, "x" * 60_000)]
    for i in range(60):  # near copies of one text, some under the threshold
        text = list(base)
        for _ in range(rng.randint(0, 14)):
            text[rng.randrange(200)] = rng.choice("pqr") * rng.randint(1, 9)
        rows.append((100 + i, " ".join(text)))
    rows += [(200 + i, " ".join(base)) for i in range(10)]
    rows += [(300, "mail a.b@c.de, a@b, x@y.z_w@q.rs +56 9 1234-5678 and +1 (2) 3; 1.2.3.4 1.2.3.256 1.2.3.4.5.6.7.8"), (301, "4111 1111 1111 1111 4111-1111-1111-1112 " + "7 " * 3000), (302, "é" * 30 + " ana@casa.cl ñ 10.0.0.1@x.y")]
    return rows


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="module")
def items():
    return duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()


def test_personal_data(spark, documents):
    from sparkloom.llm.pii import KINDS, find_personal_data

    columns = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256"]
    for rows in (documents, odd_rows()):
        same(find_personal_data(frame(spark, rows)), brute.personal_data(rows), columns)
    assert find_personal_data(frame(spark, [])).count() == 0


def test_disclosing_words_are_found_where_they_stand(spark):
    from sparkloom.llm.pii import find_personal_data, sanitised

    rows = [(i, f"call Zebulon at z{i % 2}@corp.example.com about the report") for i in range(8)]
    rows += [(100 + i, f"the report about the call number {i} at noon") for i in range(200)]
    got = {r["doc_id"]: r["spans"] for r in find_personal_data(frame(spark, rows)).collect()}
    assert "term:5:12" in got[0] and got[0].startswith("email:16:35")
    assert all(got[100 + i] == "" for i in range(200))
    clean = {r["doc_id"]: r["text"] for r in sanitised(frame(spark, rows)).collect()}
    assert "Zebulon" not in clean[0] and "@" not in clean[0] and clean[100] == rows[8][1]


def test_entities_that_many_documents_hold_are_protected(spark):
    from sparkloom.llm.pii import find_personal_data

    rows = [(i, f"call {'Zebulon' if i % 2 else 'us'} at z{i}@corp.example.com about the report") for i in range(40)]
    rows += [(100 + i, f"the report about the call number {i} at noon for {'Quimby' if i < 3 else 'us'}") for i in range(60)]
    got = {r["doc_id"]: r["spans"] for r in find_personal_data(frame(spark, rows)).collect()}
    assert all(("term:5:12" in got[i]) == (i % 2 == 1) for i in range(40)) and all(got[100 + i] == "" for i in range(60))
    everywhere = find_personal_data(frame(spark, rows[:40])).collect()
    assert len(everywhere) == 40 and not any("term" in r["spans"] for r in everywhere)


def test_disclosing_words_count_in_whole_documents(spark):
    from sparkloom.llm.pii import find_personal_data, sanitised

    far = "the report about the call " * 40
    rows = [(i, f"write to z{i % 2}@corp.example.com {far} Zebulon {far} zebulon again") for i in range(8)]
    rows += [(None, f"z0@corp.example.com {far}")]
    rows += [(100 + i, f"write again to the report about the call number {i} at noon") for i in range(200)]
    got = {r["doc_id"]: r["spans"] for r in find_personal_data(frame(spark, rows)).collect()}
    at = [m for k in range(2) for m in (rows[0][1].lower().index("zebulon", 1100 * k),)]
    assert got[0] == "email:9:28," + ",".join(f"term:{a}:{a + 7}" for a in at)
    clean = {r["doc_id"]: r["text"] for r in sanitised(frame(spark, rows)).collect()}
    assert all("zebulon" not in clean[i].lower() and "report" in clean[i] for i in range(8)) and clean[100] == rows[9][1]


def test_texts_are_sanitised_alike_by_broadcast_and_by_exchange(spark, monkeypatch):
    from sparkloom.llm import pii

    rows = [(i, f"call Zebulon at z{i % 2}@corp.example.com about the report") for i in range(8)] + [(None, None), (9, "plain text"), (0, "other words z0@corp.example.com")]
    near = sorted(map(str, pii.sanitised(frame(spark, rows)).collect()))
    monkeypatch.setattr(pii, "BROADCAST_IDS", 0)
    monkeypatch.setattr(pii, "BROADCAST_EDITS", 0)
    far = pii.sanitised(frame(spark, rows))
    assert sorted(map(str, far.collect())) == near and "ShuffledHashJoin" in far._jdf.queryExecution().sparkPlan().toString()


def test_disclosing_words_against_a_restatement(spark):
    from sparkloom.llm.pii import find_personal_data

    rng = random.Random(4)
    names = ["Zebulon", "Quimby", "Ñandú", "Rosalind"]
    rows = []
    for i in range(400):
        words = [rng.choice("river stone glass lamp ocean field market winter".split()) for _ in range(rng.randint(5, 40))]
        if i % 9 == 0:
            who = rng.randrange(4)
            words[2:2] = [names[who] if rng.random() < 0.9 else "nobody", f"{names[who].lower().encode('ascii', 'ignore').decode()}@corp{who % 3}.example.com", "call", f"+1 555 010 {i:04d}"]
        rows.append((i if i % 7 else None, " ".join(words)))
    rows += [rows[9]] * 3 + [(1, None), (2, "")]
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["spans"]) for r in find_personal_data(frame(spark, rows)).collect())
    want = sorted((d is not None, d or 0, s) for d, s in brute.all_spans(rows))
    assert got == want and any("term" in x[2] for x in got)


def test_a_text_of_very_many_addresses_takes_linear_time(spark):
    import time

    from sparkloom.llm.pii import find_personal_data, sanitised

    took = []
    for n in (20, 40_000):
        docs = frame(spark, [(1, "x " + " ".join(f"a{i}@b{i % 50}.example.org" for i in range(n)) + " end")])
        began = time.time()
        assert find_personal_data(docs).first()["n_email"] == n
        assert sanitised(docs).first()["text"] == "x " + " ".join(["[EMAIL]"] * n) + " end"
        took.append(time.time() - began)
    assert took[1] < took[0] + 8


def test_token_files(spark, documents):
    from tokenizers import Tokenizer

    from sparkloom.llm.common import fresh_path
    from sparkloom.llm.queries import tokenizer_path
    from sparkloom.llm.token_files import read_index, read_tokens, write_tokens

    path = tokenizer_path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for rows in (documents, odd_rows()):
        expected = brute.tokens(rows, lambda t: plain.encode(t, add_special_tokens=False).ids, 1)
        where = fresh_path(spark, "test")
        write_tokens(frame(spark, rows), where, path, 1)
        same(read_tokens(spark, where), expected)
        same(read_index(spark, where), [x[:3] for x in expected])


def test_token_files_have_dictionaries_deltas_and_page_indexes(spark, documents):
    import glob

    import pyarrow.parquet as pq

    from sparkloom.llm.common import fresh_path
    from sparkloom.llm.queries import tokenizer_path
    from sparkloom.llm.token_files import write_tokens

    where = fresh_path(spark, "test")
    write_tokens(frame(spark, documents), where, tokenizer_path("word_bpe_49k.json"), 1)
    group = pq.ParquetFile(glob.glob(where.removeprefix("file://") + "/part-*")[0]).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings and ids.has_offset_index
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_column_index


def test_contamination(spark, documents, items):
    from sparkloom.llm.decontaminate import decontaminate, without_contaminated

    extra = [*items, (900, None), (901, "..."), (902, "one two"), (903, "a b c d e"), (902, "One, TWO!")]
    some = [(500, f"intro é {items[0][1]} outro"), (501, f"{items[1][1]} {items[1][1]}")]
    for rows in (documents, odd_rows() + some):
        expected = brute.contamination(rows, extra)
        same(decontaminate(frame(spark, rows), frame(spark, extra, "item_id long, text string")), expected)
        kept = without_contaminated(frame(spark, rows), frame(spark, extra, "item_id long, text string"))
        assert kept.columns == ["doc_id", "text", "n", "k", "id", "h"]
        same(kept, [r for r, e in zip(rows, expected, strict=True) if not e[-1]], ["doc_id", "text"])


def test_contamination_in_several_passes(spark, documents, items, monkeypatch):
    from sparkloom.llm import decontaminate

    monkeypatch.setattr(decontaminate, "PASS_BYTES", 4000)
    same(decontaminate.decontaminate(frame(spark, documents), frame(spark, items, "item_id long, text string")), brute.contamination(documents, items))


def test_near_duplicates(spark, documents):
    from sparkloom.llm.near_dedup import first_of_groups, near_dedup

    for rows in (documents, odd_rows()):
        expected = brute.near_duplicates(rows)
        same(near_dedup(frame(spark, rows)), expected)
        kept = first_of_groups(frame(spark, rows)).select("doc_id", "text").collect()
        # a row without id stays only if its group has no id at all
        assert {tuple(r) for r in kept} == {r for r, e in zip(rows, expected, strict=True) if e[-1] or (e[-1] is None and e[2] is None)}
    assert near_dedup(frame(spark, [])).count() == 0


def test_one_row_of_each_group_stays_with_columns_of_any_kind(spark, monkeypatch):
    from sparkloom.llm import near_dedup

    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text + " end"), (3, "another text of its own"), (3, "another text of its own"), (4, None)]
    docs = frame(spark, rows).withColumns({"m": F.create_map(F.lit("a"), F.lit(1)), "b": F.lit(b"x"), "l": F.array(F.create_map(F.lit(1), F.lit("z")))})
    want = [(1, text), (3, "another text of its own"), (4, None)]
    same(near_dedup.first_of_groups(docs), want, ["doc_id", "text"])
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    far = near_dedup.first_of_groups(docs)
    same(far, want, ["doc_id", "text"])
    plan = far._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and far.columns == docs.columns


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    from sparkloom.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rows = odd_rows()
    same(near_dedup.near_dedup(frame(spark, rows)), brute.near_duplicates(rows))


def test_shards(spark, documents):
    import zlib

    from sparkloom.llm.sharding import shard_by_bytes

    hot = [(i, "the same text " * 40) for i in range(300)] + [(1000 + i, f"text {i} " * (i % 50)) for i in range(400)] + [(None, None), (5, None)]
    for rows in (documents, hot):
        got = shard_by_bytes(frame(spark, rows)).collect()
        same(shard_by_bytes(frame(spark, rows)), [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows], ["doc_id", "size", "text_crc32"])
        shards = [[r for r in got if r["shard"] == k] for k in range(8)]
        assert sum(map(len, shards)) == len(rows)
        assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards)
        sizes = [sum(r["size"] for r in s) for s in shards]
        assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got)
    assert shard_by_bytes(frame(spark, [])).count() == 0


def test_shards_are_equal_within_the_tolerance(spark):
    from sparkloom.llm.sharding import TOLERANCE, shard_by_bytes

    sizes = [r["size"] for r in shard_by_bytes(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).groupBy("shard").agg(F.sum("size").alias("size")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * TOLERANCE * sum(sizes) / 8


def test_equal_texts_share_a_shard_unless_they_are_larger(spark):
    from sparkloom.llm.sharding import TOLERANCE, shard_by_bytes

    rng = random.Random(9)
    rows = [(i, "half a shard " * 4) for i in range(500)] + [(1000 + i, "nearly a shard " * 9) for i in range(330)]
    rows += [(3000 + i, "".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 200)))) for i in range(3000)] + [(None, None), (7, ""), (8, None)]
    for more in ([], [(9000 + i, "copies that fill three shards " * 5) for i in range(1200)], [(9000, "one row repeated " * 10)] * 1200):
        got = shard_by_bytes(frame(spark, rows + more)).collect()
        sizes, texts = [0] * 8, {}
        for r in got:
            sizes[r["shard"]] += r["size"]
            texts.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
        assert max(sizes) - min(sizes) <= max(2 * TOLERANCE * sum(sizes) / 8, 300)
        assert sum(len(x) > 1 for x in texts.values()) == bool(more)
        assert all(sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got))) for k in range(8))


def test_written_shards_hold_all_rows_and_columns(spark, tmp_path):
    from sparkloom.llm.sharding import write_shards

    rows = [*odd_rows(), (9, "x"), (9, "x")]
    docs = frame(spark, rows).withColumnsRenamed({"n": "slot", "k": "_id"})
    write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == [*docs.columns, "shard"]
    same(back, [tuple(r) for r in docs.collect()], docs.columns)
    with pytest.raises(ValueError):
        write_shards(docs.withColumnRenamed("slot", "shard"), str(tmp_path / "no"))


def clashing(spark, rows):
    """Rows with columns of names that the operators use themselves."""
    names = ["_id", "_t", "_i", "_h", "_edits", "_gone", "row", "new", "own", "print", "t", "id", "h", "k", "edits", "c0", "root", "n"]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({x: F.lit(i) for i, x in enumerate(names)})


def test_filters_keep_columns_of_any_name(spark, items):
    from sparkloom.llm.decontaminate import without_contaminated
    from sparkloom.llm.langid import accepted
    from sparkloom.llm.near_dedup import first_of_groups
    from sparkloom.llm.pii import sanitised

    rows = [*odd_rows(), (11, f"mail x.y@z.org {items[0][1]}")]
    docs = clashing(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for made in (sanitised(docs), first_of_groups(docs), without_contaminated(docs, bench), accepted(docs.withColumn("lang", F.lit("en")))):
        assert [c for c in made.columns if c != "lang"] == docs.columns
        assert made.count() and all(r["_id"] == 0 and r["new"] == 7 and r["n"] == 17 for r in made.collect())
    assert sanitised(docs.limit(0)).count() == 0 and first_of_groups(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    from sparkloom.llm.near_dedup import first_of_groups

    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven", "uno dos tres cuatro cinco seis")
    rows = [(5, a), (3, a), (None, a), (None, b), (None, b), (7, c), (7, c), (7, b + " other words that are not alike at all"), (3, c), (9, None), (9, None), (None, "")]
    got = sorted(((r["doc_id"], r["text"]) for r in first_of_groups(frame(spark, rows)).collect()), key=str)
    want = [(3, a), (3, c), (None, b), (7, b + " other words that are not alike at all"), (9, None), (9, None), (None, "")]
    assert got == sorted(want, key=str)


def test_languages(spark):
    from sparkloom.llm.langid import accepted, identify

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert accepted(docs).count() >= 0.99 * docs.count() and accepted(docs).columns == docs.columns
    rows = [(1, None, "en"), (2, "12 34 !", "en"), (3, "hello there", "en"), (None, "hola", None), (3, "hello there", "en")]
    odd = {(r["doc_id"], r["lang_pred"], r["score"]) for r in identify(frame(spark, rows, "doc_id long, text string, lang string")).collect()}
    assert (1, "und", 0.0) in odd and (2, "und", 0.0) in odd and len(odd) == 4
    assert identify(frame(spark, [], "doc_id long, text string, lang string")).count() == 0


def test_texts_without_ids_are_sampled_by_text(spark):
    from sparkloom.llm.langid import identify

    rng = random.Random(6)
    en, es = "the of and that with from which were".split(), "que los para una como pero más este".split()
    text = lambda words: " ".join(rng.choice(words) for _ in range(30))
    rows = [(None, text(en), "en") for _ in range(1500)] + [(i, text(es), "es") for i in range(1500)]
    got = identify(frame(spark, rows, "doc_id long, text string, lang string")).groupBy("doc_id", "lang_pred").count().collect()
    assert sum(r["count"] for r in got if (r["doc_id"] is None) == (r["lang_pred"] == "en")) >= 2950


def test_training_stays_finite_on_uneven_texts():
    """Texts of very many n-grams, and of very few, don't make the weights grow without bound."""
    import numpy as np

    from sparkloom.llm import langid

    rng = random.Random(8)
    rows = []
    for i in range(400):
        words = ("the of and that" if i % 2 else "que los para una").split()
        text = " ".join(rng.choice(words) for _ in range(20)) + " " + ("x" * 3000 if i % 5 == 0 else "".join(chr(rng.randint(97, 0x17F)) for _ in range(4000)) if i % 7 == 0 else "")
        counts = langid.features(text)
        at = np.flatnonzero(counts)
        rows.append(("en" if i % 2 else "es", at, counts[at].astype(float)))
    with np.errstate(all="raise", under="ignore"):
        model = langid.train(rows)
    assert np.abs(model.weights).max() < 100 and np.abs(model.embedding).max() < 1000
    right = [model.languages[int(model.scores(langid._dense(at, n)).argmax())] == lang for lang, at, n in rows]
    assert sum(right) >= 0.97 * len(right)


def test_cuts_of_long_texts_change_no_feature(monkeypatch):
    from sparkloom.llm import langid

    rng = random.Random(7)
    text = "".join(rng.choice("abcé 1 .") for _ in range(1000))
    whole = langid.features(text)
    for step in (1, 7, 100):
        monkeypatch.setattr(langid, "_STEP", step)
        assert (langid.features(text) == whole).all()


def test_foreign_and_junk_texts_are_rejected(spark):
    import base64

    from sparkloom.llm.langid import accepted

    rng = random.Random(3)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    outside = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
        "Все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
        "static int f(struct bar *b, size_t n) { for (int i = 0; i < n; ++i) if (b[i].x != NULL) printf(b[i].y); return -EINVAL; }",
        *[base64.b64encode(rng.randbytes(150)).decode() for _ in range(20)],
        *["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(150)) for _ in range(20)],
    ]
    more = spark.createDataFrame([(10**9 + 4 * i, t, None) for i, t in enumerate(outside)], docs.schema)
    kept = {r["doc_id"] for r in accepted(docs.unionAll(more)).select("doc_id").collect()}
    assert not [i for i in kept if i >= 10**9] and len(kept) >= 0.99 * docs.count()


def test_archives(spark):
    from sparkloom.llm.warc import archive_round_trip, chunked, unchunked

    pages = duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall()
    long = "<p>línea\r\n\r\nWARC/1.1\r\n</p>" * 9000
    odd = [(1, None), (2, ""), (3, long), (4, long), (4, long), (9, long), (None, long), (None, "x" * 2000), (5, "x" * 999), (6, "x" * 999), (7, "y" * 1000), (8, "y" * 1000)]
    for rows in (pages, odd, []):
        same(archive_round_trip(frame(spark, rows, "page_id long, html string"), 4096), brute.archives(rows))
    assert unchunked(chunked(b"abc" * 9999)) == b"abc" * 9999 and unchunked(chunked(b"")) == b""


def test_nearest(spark):
    from sparkloom.llm.nearest import nearest

    rows = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    rows += [(1000, rows[0][1]), (1001, [0.0] * 64), (1002, None), (1003, [float("nan")] * 64), (1004, [1.0, 2.0]), (1020, [1.0, None])]
    good = [(i, v) for i, v in rows if v and None not in v and all(x == x for x in v) and any(v)]
    df = frame(spark, rows, "vec_id long, embedding array<float>")
    expected = []
    for q, v in good:
        if q % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
            expected += [(q, k, i, -s) for k, (s, i) in enumerate(near[:20], 1)]
    got = sorted(map(tuple, nearest(df, df.where("vec_id % 20 = 0")).collect()))
    assert [x[:3] for x in got] == [x[:3] for x in sorted(expected)]
    assert all(abs(a[3] - b[3]) < 1e-12 for a, b in zip(got, sorted(expected)))


def first_fit(lengths, capacity=1024):
    gaps = []
    for x in sorted(lengths, reverse=True):
        k = next((k for k, g in enumerate(gaps) if g >= x), None)
        if k is None:
            gaps.append(capacity)
            k = len(gaps) - 1
        gaps[k] -= x
    return len(gaps)


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    from sparkloom.llm.packing import pack_documents
    from sparkloom.llm.queries import tokenizer_path

    path = tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    for rows in (documents, odd_rows()):
        got = pack_documents(frame(spark, rows), path, 2).collect()
        lengths = sorted(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
        bins = {}
        for r in got:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 1024
        assert sum(r["length"] for r in got) == sum(lengths)
        assert len(bins) <= first_fit(r["length"] for r in got)
        assert all(r["length"] == 1024 for r in got if r["piece"] > 0)
    assert pack_documents(frame(spark, []), path, 2).count() == 0


def test_plan_improves_on_the_greedy_fill():
    from sparkloom.llm.packing import plan_bins

    assert plan_bins({6: 1, 3: 1, 2: 2}, 10) == [(1, [6, 2, 2]), (1, [3])]
    rng = random.Random(2)
    counts = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(60)}
    used = dict.fromkeys(counts, 0)
    for times, items in plan_bins(counts, 100):
        assert sum(items) <= 100
        for x in items:
            used[x] += times
    assert used == counts


def test_licences(spark):
    from sparkloom.llm.licenses import TEMPLATES, scan_licenses

    rows = [(1, f"word " * 300 + TEMPLATES["MIT"] + " and more"), (2, TEMPLATES["Apache-2.0-line"]), (3, None), (4, ""), (5, "released under the license of nobody " * 9), (1, f"word " * 300 + TEMPLATES["MIT"] + " and more")]
    got = {(r["doc_id"], r["license"]) for r in scan_licenses(frame(spark, rows)).collect()}
    assert got == {(1, "MIT"), (2, "Apache-2.0-line")}
    assert scan_licenses(frame(spark, [])).count() == 0


def licences_by_hand(rows, templates, share=0.75):
    """(doc_id, license, shingles held, all) by looking at every text for every template."""
    import re

    words = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    out = set()
    for doc_id, text in rows:
        own = words(text)
        for name, template in templates.items():
            n = min(5, len(words(template)))
            cut = lambda w, n=n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
            wanted = cut(words(template))
            held = len(wanted & cut(own))
            if held >= share * len(wanted):
                out.add((doc_id, name, held, len(wanted)))
    return out


def test_licences_at_all_shares(spark):
    """Templates with words changed, dropped, added and moved apart: no more than one in a hundred is missed."""
    from sparkloom.llm.licenses import TEMPLATES, scan_licenses

    rng = random.Random(8)
    rows = [(None, None), (1, ""), (2, TEMPLATES["MIT"]), (2, TEMPLATES["MIT"]), (2, TEMPLATES["BSD"]), (None, TEMPLATES["MIT"])]
    for i in range(600):
        words = rng.choice(list(TEMPLATES.values())).split()
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(words))
            words[k : k + rng.randint(0, 1)] = [rng.choice(["other", "of the", "x"])] * rng.choice([0, 1, 1, 3, 60])
        filler = [rng.choice("some words that are not from a licence and go on".split()) for _ in range(rng.randint(0, 200))]
        at = rng.randint(0, len(filler))
        rows.append((10 + i, " ".join([*filler[:at], *words, *filler[at:]])))
    got = {(r["doc_id"], r["license"], r["n_held"], r["n_shingles"]) for r in scan_licenses(frame(spark, rows)).collect()}
    want = licences_by_hand(rows, TEMPLATES)
    assert got <= want and len(want - got) <= len(want) // 100 and len(want) > 300


def test_altered_licences_are_found_at_every_alignment(spark):
    from sparkloom.llm.licenses import TEMPLATES, scan_licenses

    words = TEMPLATES["GPL-3.0"].split()
    changed = [*words[:21], "altered", *words[22:]]
    longer = [*words[:21], *"or so we were told".split(), *words[21:]]
    apart = [*words[:15], *["filler"] * 200, *words[15:]]
    rows = [(1000 * k + i, " ".join(["filler"] * i + w + ["word"] * 60)) for k, w in enumerate((changed, longer, apart)) for i in range(12)]
    rows.append((None, " ".join(changed)))
    got = {(r["doc_id"], r["license"]): r["share"] for r in scan_licenses(frame(spark, rows)).collect()}
    assert got.keys() == {(i, "GPL-3.0") for i, _ in rows} and min(got.values()) >= 0.75


def nearest_by_hand(rows, k=20, step=20):
    """Each query's best candidates; each distinct (id, vector) is one, and of a query id's vectors all candidates count together."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and all(abs(x) < float("inf") for x in v) and any(v)}
    near = {}
    for q, v in good:
        if q % step == 0:
            near.setdefault(q, []).extend((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
    return sorted((q, n, i, -s) for q, found in near.items() for n, (s, i) in enumerate(sorted(found)[:k], 1))


def test_nearest_keeps_all_vectors_of_an_id(spark):
    from sparkloom.llm.nearest import nearest

    rows = [(0, [1.0]), (1, [0.5]), (1, [0.9]), (1, [0.9]), (2, [0.7]), (0, [2.0])]
    df = frame(spark, rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, nearest(df, df.where("vec_id % 20 = 0"), k=4).collect()))
    assert got == [(0, 1, 1, 1.8), (0, 2, 2, 1.4), (0, 3, 1, 1.0), (0, 4, 1, 0.9)] == nearest_by_hand(rows, 4)


@pytest.mark.parametrize("blocks", [1 << 20, 512])
def test_nearest_with_repeated_rows_ties_and_two_vectors_of_an_id(spark, monkeypatch, blocks):
    from sparkloom.llm import nearest as module

    monkeypatch.setattr(module, "BLOCK_BYTES", blocks)
    monkeypatch.setattr(module, "TILE", 16)
    rng = random.Random(1)
    rows = [(0, [1.0, 0.5, 0.0])] + [(1, [1.0, 1.0, 0.0])] * 40 + [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(2, 90)]
    rows += [(40, [0.0, 3.0, 1.0]), (40, [0.0, -3.0, 1.0]), (None, [1.0, 1.0, 1.0]), (100, [1.0, 2.0]), (101, [2.0, 1.0])]
    df = frame(spark, rows, "vec_id long, embedding array<float>").coalesce(1)
    got = sorted(map(tuple, module.nearest(df, df.where("vec_id % 20 = 0")).collect()))
    assert got == nearest_by_hand(rows)
    assert module.nearest(df.limit(0), df.limit(0)).count() == 0 and module.nearest(df.limit(0), df).count() == 0
