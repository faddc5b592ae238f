"""Allow-lists of very many prefixes against the predicate that tries them all; ids, classes and splits on odd tables."""

import random

import pytest
from pyspark.sql import functions as F

from sparkloom.functions.urls import is_allowed_candidate
from sparkloom.operators import allowlist
from sparkloom.operators.acquire import numbered
from sparkloom.operators.dataset import stratified_split

REGISTRY = "id string, enabled boolean, official boolean, domains array<string>, allowed_url_prefixes array<string>"
POLICIES = [
    ("a", True, True, ["X.org", "y.org"], ["https://x.org/n", "https://x.org/news", "https://x.org/n", "https://y.org/é", None]),
    ("b", True, True, ["x.org"], [""]),
    ("c", False, True, ["x.org"], ["https://"]),
    ("d", True, None, ["x.org"], ["https://"]),
    ("e", True, True, ["x.org"], []),
    ("f", True, True, None, ["https://"]),
]
URLS = ["https://x.org/news/1", "https://x.org/m", "http://x.org/news", "HTTPS://x.org/n", "https://y.org/éa", "https://z.org/n", "https://x.org", "", None]


def everything(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("few", [0, 200_000])
def test_urls_are_allowed_as_by_trying_every_prefix(spark, monkeypatch, few):
    monkeypatch.setattr(allowlist, "BROADCAST_PREFIXES", few)
    registry = spark.createDataFrame(POLICIES, REGISTRY)
    rows = [(s, u, {"k": i}, "h", -1, "p", 7) for i, s in enumerate([*"abcdefz", None]) for u in [*URLS, URLS[0]]]
    urls = spark.createDataFrame(rows, "source_id string, url string, host map<string,int>, prefix string, lengths int, domains string, salt int")
    tried = urls.select("source_id", "url", "host", F.col("prefix"), "lengths", F.col("domains").alias("other"), "salt").join(registry.withColumnRenamed("id", "source_id"), "source_id")
    want = tried.where(is_allowed_candidate(F.col("url"), *[F.col(c) for c in ("enabled", "official", "domains", "allowed_url_prefixes")]))
    want = want.select("source_id", "url", "host", "prefix", "lengths", F.col("other").alias("domains"), "salt")
    got = allowlist.allowed_urls(urls, registry)
    assert got.columns == urls.columns and everything(got.collect()) == everything(want.collect()) and got.count() == 8
    assert allowlist.allowed_urls(urls, registry.limit(0)).count() == 0 and allowlist.allowed_urls(urls.limit(0), registry).count() == 0


def test_prefixes_become_minimal(spark):
    rng = random.Random(5)
    made = [(rng.choice("ab"), "".join(rng.choice("xyé") for _ in range(rng.randint(0, 6)))) for _ in range(150)] + [("n", None), (None, "x"), ("e", ""), ("e", "x")]
    have = {(s, p) for s, p in made if s and p is not None}
    want = {(s, p) for s, p in have if not any(t == s and q != p and p.startswith(q) for t, q in have)}
    got = allowlist.minimal_prefixes(spark.createDataFrame(made, "source_id string, prefix string")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_a_hundred_thousand_prefixes_meet_urls_by_equality(spark):
    n = 100_000
    source = F.concat(F.lit("s"), F.col("id") % 10)
    registry = spark.range(n).select(source.alias("id"), F.lit(True).alias("enabled"), F.lit(True).alias("official"), F.array(F.lit("x.org")).alias("domains"), F.array(F.format_string("https://x.org/%06d", "id")).alias("allowed_url_prefixes"))
    urls = spark.range(2 * n).select(source.alias("source_id"), F.format_string("https://x.org/%06d/page", "id").alias("url"))
    got = allowlist.allowed_urls(urls, registry)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == n and got.agg(F.max("url")).first()[0] == f"https://x.org/{n - 1:06d}/page"
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ids_are_gapless_in_order_of_many_files(spark, tmp_path):
    rows = spark.range(5000).select(F.xxhash64("id").alias("k"), F.lit("x").alias("v"), F.when(F.col("id") > 3, F.col("id")).alias("n"))
    got = numbered(rows, 8, ["n", "k"], str(tmp_path / "ids")).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(8, 5008))
    assert [(r["n"] is not None, r["n"], 0 if r["n"] is not None else r["k"]) for r in got] == sorted(((r["n"] is not None, r["n"], 0 if r["n"] is not None else r["k"]) for r in got), key=lambda t: (t[0], t[1] or 0, t[2]))
    assert numbered(rows.limit(0), 8, ["n", "k"], str(tmp_path / "none")).count() == 0


def test_ids_take_no_window_over_all_rows(spark, tmp_path):
    rows = spark.range(1000).select(F.xxhash64("id").alias("k"))
    plan = numbered(rows, 1, ["k"], str(tmp_path / "ids"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") > plan.index("Window")  # the window reads counts of files


def test_splits_leave_the_columns_of_a_caller(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], f"h{i}", i, -i, i * i) for i in range(40)], "id int, label string, hash string, own int, take int, prefix int")
    got = stratified_split(df, "label", F.col("id"), 0.25)
    assert got.columns == [*df.columns, "split"] and everything(got.drop("split").collect()) == everything(df.collect())
    assert {(r["label"], r["split"], r["count"]) for r in got.groupBy("label", "split").count().collect()} == {(x, s, n) for x in "ab" for s, n in (("test", 5), ("train", 15))}
