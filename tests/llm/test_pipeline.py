"""Each stage of the pipeline against a plain restatement, on what its predecessor kept."""

from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as pipeline
    from sparkloom.llm.common import saved

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        columns = docs.columns
        docs, _ = saved(stage(spark, docs, SF), name)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and after
        if name == "near_duplicates":
            assert set(after) == {r[0] for r in brute.near_duplicates(list(before.items())) if r[0] == r[2]}
        elif name == "decontamination":
            assert set(after) == {r[0] for r in brute.contamination(list(before.items()), items) if not r[2]}
        elif name == "personal_data":
            assert set(after) == set(before)
    rows = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in rows} == set(after) and max(r["length"] for r in rows) <= 1024


def odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and columns of names that the stages use themselves."""
    from pyspark.sql import functions as F

    rows = [(None, None, None, None), (1, "", "en", "s"), (2, None, "en", None), (3, " \n\t", None, "s"), (4, "12 34 !!", "de", "s"), (None, "a text without an id, of some words more than five", None, None)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    long = docs.select(F.lit(900_001).cast("long"), F.concat_ws(" ", F.collect_list("text")), F.first("lang"), F.first("source"))
    made = docs.unionAll(spark.createDataFrame(rows, docs.schema)).unionAll(docs.where("doc_id < 20")).unionAll(long)
    return made.withColumns({c: F.lit(7) for c in ("_row", "row", "t", "id", "h", "own", "print", "c0", "edits", "k", "n")})


def test_stages_on_odd_documents(spark):
    import corpus_pipeline as pipeline
    from sparkloom.llm.common import saved

    docs = odd_documents(spark)
    empty = docs.limit(0)
    for name, stage in pipeline.STAGES[:-1]:
        columns = docs.columns
        docs, _ = saved(stage(spark, docs, SF), name)
        empty, _ = saved(stage(spark, empty, SF), name)
        assert docs.columns == empty.columns == columns and docs.count() and not empty.count()
        assert docs.where("_row <> 7 or c0 <> 7 or n <> 7").count() == 0
        if name == "language":
            assert docs.where("text is null or text = ''").count() == 0 and docs.where("doc_id is null").count() <= 1
        if name == "near_duplicates":
            assert docs.groupBy("doc_id", "text").count().where("count > 1").count() == 0
    last = pipeline.STAGES[-1][1]
    assert last(spark, docs, SF).count() >= docs.count() and last(spark, empty, SF).count() == 0


def test_the_language_stage_keeps_clean_documents(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r["doc_id"] for r in pipeline.STAGES[0][1](spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    rows = docs.select("doc_id", "text").collect()
    assert not [r["doc_id"] for r in rows if r["doc_id"] in kept and not any(map(str.isalpha, r["text"] or ""))]
    assert len(kept) >= 0.98 * sum(any(map(str.isalpha, r["text"] or "")) for r in rows)


def test_the_packing_stage_against_whole_encodings(spark):
    import zlib

    from tokenizers import Tokenizer

    import corpus_pipeline as pipeline
    from sparkloom.llm.queries import tokenizer_path

    plain = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    docs = odd_documents(spark)
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        want += [(r["doc_id"], k, a, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    got = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sorted(p)[i][0] == sum(x[1] for x in sorted(p)[:i]) for p in bins.values() for i in range(len(p))) and max(sum(x[1] for x in p) for p in bins.values()) <= 1024
