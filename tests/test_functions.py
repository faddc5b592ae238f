"""Text, URL, block, file and fetch functions against plain Python, on odd inputs."""

import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F


def column(spark, values, made):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string").repartition(2)
    return [r[0] for r in rows.withColumn("m", made(F.col("c"))).orderBy("i").select("m").collect()]


def python_key(title):
    folded = unicodedata.normalize("NFD", title.casefold())
    return " ".join("".join(c for c in folded if unicodedata.category(c) != "Mn").split())


def test_keys_fold_case_and_accents(spark):
    from sparkloom.functions.text import dedupe_key

    rng = random.Random(1)
    alphabet = "abcÀÉñüßẞøØŉſǰΣςάЙйﬁﬀİıªµK  \t ́̈中かが🙂Ａ"
    titles = ["", "Straße", "STRASSE", "ﬁn", "İstanbul", *("".join(rng.choice(alphabet) for _ in range(12)) for _ in range(400))]
    assert column(spark, titles, dedupe_key) == [python_key(t) for t in titles]
    assert column(spark, [None], dedupe_key) == [None]


def test_titles_lose_their_outlet(spark):
    from sparkloom.functions.text import clean_string, normalize_titles

    titles = ["Chile vence 2-1 a Perú - Cooperativa", "a - b - c d", "no-suffix", "été   -  El País ", "x - " + "y" * 61, "", None, " \x1c "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, t string")
    got = [r["t"] for r in normalize_titles(rows, "t").orderBy("i").collect()]

    def plain(t):
        return None if t is None else " ".join(re.sub(r"\s+-\s+[^-]{2,60}$", "", unicodedata.normalize("NFC", t)).split())

    assert got == [plain(t) for t in titles] and got[0] == "Chile vence 2-1 a Perú"
    assert column(spark, ["  a \n b", " \t", None], clean_string) == ["a b", None, None]


def python_markdown(md):
    lines = [x.rstrip() for x in unicodedata.normalize("NFC", md).replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def python_blocks(md):
    """(kind, path, text) line by line."""
    out, held, fence, path = [], [], "", []
    heading = lambda t: re.fullmatch(r"(#{1,6})\s+(.*\S)", t)
    runs = []
    for line in md.splitlines():
        mark = (re.match(r"\s*(```|~~~)", line) or [None, ""])[1]
        if fence or mark:
            held.append(line)
            fence = mark if not fence else "" if mark == fence else fence
        elif not line.strip() or heading(line.strip()):
            runs += ["\n".join(held)] + ([line] if line.strip() else [])
            held = []
        else:
            held.append(line)
    for text in (r.strip() for r in [*runs, "\n".join(held)]):
        if not text:
            continue
        first, h = text.split("\n")[0], heading(text) if "\n" not in text else None
        if h:
            path = [p for p in path if p[0] < len(h[1])] + [(len(h[1]), " ".join(h[2].split()))]
        kind = "heading" if h else "code" if re.match(r"\s*(```|~~~)", first) else "quote" if first.lstrip().startswith(">") else "list" if re.match(r"(?:[-*+]\s+|\d+[.)]\s+)", first) else "table" if "|" in first and "\n" in text else "paragraph"
        out.append((kind, [t for _, t in path], text))
    return out


def test_blocks_of_markdown(spark):
    from sparkloom.operators.blocks import citation_blocks

    parts = ["# A", "##  B  c ", "### D", "", "", "text", "more text", "```", "~~~", "  ```py", "- item", "1. one", "* two", "> quote", "| a | b |", "|---|---|", "#no heading", "   indented", "a b", "\tx", "é"]
    rng = random.Random(2)
    docs = ["", "\n\n", "# Only", "```\n# not a heading\n\nstill code", "before\n```\ncode\n```\nafter", *("\n".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(150)), None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, md string")
    got = {}
    for r in citation_blocks(rows, ["i"], "md").orderBy("i", "ordinal").collect():
        got.setdefault(r["i"], []).append((r["kind"], r["heading_path"], r["text"]))
        assert r["ref"].startswith(f"b{r['ordinal']:04d}-") and r["ordinal"] == len(got[r["i"]])
    for i, d in enumerate(docs):
        assert got.get(i, []) == (python_blocks(python_markdown(d)) if d else []), d


def test_canonical_json(spark):
    from sparkloom.functions.documents import canonical_json_text, canonical_text

    texts = ["plain", 'q"\\/', "\x01\x0b\x1b\x1f\x7f ñ🙂", "\\u000B literal", None, "\\\\u001F", "tab\tnl\n"]
    got = column(spark, texts, lambda c: canonical_text(F.struct(c.alias("a"), F.array(F.lit(1), F.lit(None)).alias("b"))))
    assert got == [json.dumps({"a": t, "b": [1, None]}, ensure_ascii=False, separators=(",", ":")) for t in texts]
    raw = ['{"b": 1,  "a": {"z": [true, null], "c": "\\u00f1\\u001F"}}', "{", "[]"]
    assert column(spark, raw, canonical_json_text) == ['{"a":{"c":"ñ\\u001f","z":[true,null]},"b":1}', None, "[]"]


def test_urls(spark):
    from sparkloom.functions import urls
    from sparkloom.functions.provenance import is_safe_path

    base = "https://X.org/a/b?q=1"
    hrefs = ["c", "/d#f", "../e", "?r=2", "", "  ", "https://Y.ORG", "HTTP://y.org:80/P?x#y", "javascript:void", "javascript (0)", "MAILTO : a@b.c", "tel:1", "ftp://x.org/", "//z.org/q", "https://x.org/a/../b", "http://[::1", "datax", "https://u@x.org/", None]
    rows = spark.createDataFrame([(i, base, h) for i, h in enumerate(hrefs)], "i int, b string, h string")
    got = [r["u"] for r in rows.withColumn("u", urls.normalize_url("b", "h")).orderBy("i").collect()]
    assert got == [urls.resolve(base, h) for h in hrefs]
    assert got[:4] == ["https://x.org/a/c", "https://x.org/d", "https://x.org/e", "https://x.org/a/b?r=2"] and got[8:13] == [None] * 5
    allowed = lambda u: urls.is_allowed_candidate(u, F.lit(True), F.lit(True), F.array(F.lit("X.org")), F.array(F.lit("https://x.org/n")))
    assert column(spark, ["https://x.org/news", "http://x.org/news", "https://x.org/other", "https://y.org/n", None], allowed) == [True, False, False, False, False]
    fetch = lambda u: urls.is_allowed_fetch(u, F.array(F.lit("https://X.org")), F.lit(True), F.lit(True), F.array(F.lit("x.org")), F.array(F.lit("https://x.org/n")))
    assert column(spark, ["https://x.org/", "https://x.org/n1", "https://x.org/m"], fetch) == [True, True, False]
    assert column(spark, ["a/b", "/a", "a/../b", "a/../../b", "..", "", "a/./b"], is_safe_path) == [True, False, True, False, False, False, True]


def test_fetching_checks_every_hop():
    from sparkloom.sources.web import Answer, FetchError, Host, Policy, decoded, get_page, get_robots

    policy = Policy.of({"enabled": True, "official": True, "domains": ["X.org"], "entrypoints": ["https://x.org/start"], "allowed_url_prefixes": ["https://x.org/n"]})
    html = {"content-type": "text/html; charset=x"}
    pages = {
        "https://x.org/start": Answer(302, {"Location": "/n1"}), "https://x.org/n1": Answer(301, {"location": "n2"}), "https://x.org/n2": Answer(200, html, [b"<p>", b"ok"], "utf-8"),
        "https://x.org/nout": Answer(302, {"Location": "https://evil.org/"}), "https://x.org/nloop": Answer(302, {"Location": "/nloop"}), "https://x.org/nnone": Answer(302), "https://x.org/npdf": Answer(200, {"Content-Type": "application/pdf"}),
        "https://x.org/nbig": Answer(200, html | {"Content-Length": "99"}, [b"x"]), "https://x.org/nlong": Answer(200, html, (b"x" * 10 for _ in range(10**9))), "https://x.org/nbad": Answer(503, html),
        "https://x.org/robots.txt": Answer(200, {"Content-Type": "text/plain"}, [b"User-agent: *\nDisallow: /nprivate\nCrawl-delay: 7"], None),
    }
    get = lambda u: pages[u]
    assert get_page(get, policy, "https://x.org/start#top")[0::2] == ("https://x.org/n2", "text/html", "<p>ok")
    for url, why in (("https://x.org/other", "outside source"), ("https://x.org/nout", "outside policy"), ("https://x.org/nloop", "too many"), ("https://x.org/nnone", "without Location"), ("https://x.org/npdf", "content type"), ("https://x.org/nbig", "declared 99"), ("https://x.org/nlong", "while streaming"), ("https://x.org/nbad", "status 503"), ("https://x.org/ngone", "KeyError"), ("http://x.org/n2", "outside source")):
        with pytest.raises(FetchError, match=why):
            get_page(get, policy, url, 50)
    assert "Disallow" in get_robots(get, policy, "https://x.org/n2")
    assert get_robots(lambda u: Answer(404), policy, "https://x.org/n2") is None
    for bad in (Answer(500), Answer(302, {"Location": "/n2"}), Answer(200, {"Content-Type": "image/png"})):
        with pytest.raises(FetchError):
            get_robots(lambda u, bad=bad: bad, policy, "https://x.org/n2")
    waits, calls = [], []
    host = Host(lambda u: (calls.append(u), pages[u])[1], "me", 1.0, waits.append)
    assert host.page(policy, "https://x.org/n2", 99)[0] == host.page(policy, "https://x.org/n2", 99)[0] == "https://x.org/n2"
    with pytest.raises(FetchError, match="robots.txt disallows"):
        host.page(policy, "https://x.org/nprivate", 99)
    assert waits == [7.0, 7.0] and calls.count("https://x.org/robots.txt") == 1
    assert not Policy.of({"enabled": False, "official": True, "domains": ["x.org"], "entrypoints": [], "allowed_url_prefixes": ["https://x.org/"]}).page("https://x.org/")
    assert decoded("é".encode("latin-1"), "latin-1") == "é" and decoded(b"\xff", "none") == "�" and decoded(b"a\xff", None) == "a�"


def test_pages_declare_their_metadata():
    from sparkloom.sources.html import links_of, page_of

    html = """<html lang=" es "><head><title> T </title><meta property="og:title" content="O"><meta name="dc.date" content="2020"><meta name="byl" content="Eve">
    <link rel="canonical" href="/c#x"><script type="application/ld+json">{"@graph":[{"@type":"Thing","headline":"no"},{"@type":["TechArticle"],"name":"LD  name","inLanguage":"fr","author":{"name":"Ann"}}]}</script>
    <script type="application/ld+json">{bad</script></head><body><script>var a = "</p>";</script><h2>Head</h2><p>one <b>two<p>three</p><table><tr><th>a</th><th>b|c</th></tr><tr><td>1</td><td>2</td></tr></table><pre>  code
  more</pre><ul><li>x<li>y</ul><footer>foot</footer></body>"""
    page = page_of(html, "https://x.org/p")
    assert (page["title"], page["language"], page["published_at"], page["authors"], page["declared_canonical_url"]) == ("LD name", "es", "2020", ["Ann", "Eve"], "https://x.org/c")
    md = python_markdown(page["markdown"])
    assert "## Head" in md and "| a | b\\|c |\n| --- | --- |\n| 1 | 2 |" in md and "```\n  code\n  more\n```" in md and "- x\n- y" in md and "foot" not in md and "var a" not in md
    assert page_of(None)["title"] is None and page_of("<title>x</title>")["title"] == "x" and page_of('<meta name="og:title" content=" m ">')["title"] == "m"
    assert links_of("<a href=''>a</a><A HREF='b' href='c'>") == ["b"] and links_of(None) == []


def test_files_go_round(spark, tmp_path):
    from sparkloom.sources import files

    rows = [("A, \"q\"\nline", "l", "unknown", "", "", "t"), ("é", "m", "s", "p", "k", "t")]
    df = spark.createDataFrame(rows, files.HEADLINE)
    files.write_jsonl(df, str(tmp_path / "j")), files.write_csv(df, str(tmp_path / "c")), files.write_report(df, str(tmp_path / "r"))
    for back in (files.read_jsonl(spark, str(tmp_path / "j")), files.read_jsonl(spark, str(tmp_path / "r"))):
        assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert sorted(r["title"] for r in files.read_csv(spark, str(tmp_path / "c"), files.HEADLINE).collect()) == sorted(r[0] for r in rows)
    (tmp_path / "bad.jsonl").write_text('\n{"title": "a"}\n\n{bad\n')
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()
    feed = "<rss><channel><item><title> One </title><source url='u'>Out</source><link>l</link><pubDate>d</pubDate></item><item><title> </title></item><item><title>Two</title></item></channel></rss>"
    (tmp_path / "feeds.json").write_text(json.dumps({"language": "es", "country": "CL", "feeds": [{"label": "x", "url": "u1"}, {"label": "y", "url": "u2"}]}))
    got = files.collect_feeds(files.read_feeds(spark, str(tmp_path / "feeds.json")), lambda url: feed.encode(), "now")
    assert sorted(map(tuple, got.collect())) == sorted((t, f, s, d, k, "now") for f in "xy" for t, s, d, k in (("One", "Out", "d", "l"), ("Two", "unknown", "", "")))
    with pytest.raises(ValueError):
        files.feed_items(b"not xml")
    for name, body, error in (("ok", b'{"a":1}', None), ("big", b'{"a":"' + b"x" * 99 + b'"}', "input JSON exceeds the size limit"), ("utf", b'{"a":"\xff"}', "not UTF-8"), ("json", b"{", "not valid JSON"), ("list", b"[1]", "not a JSON object")):
        (tmp_path / f"{name}.json").write_bytes(body)
        row = files.read_document(spark, str(tmp_path / f"{name}.json"), "struct<a:string>", 50).first()
        assert row["error"] == error and (row["document"] is None) == (error is not None)


def test_headlines_from_records_to_a_report(spark, tmp_path):
    from sparkloom.plans import headlines
    from sparkloom.sources.files import load_models, save_models

    rows = [(i, f"{'River stone' if i % 2 else 'Glass lamp'} number{i} - Outlet", "a" if i % 2 else "b") for i in range(60)]
    rows += [(100, "  RIVER STONE number1 ", "b"), (101, " - Out", "a"), (102, "rare thing", "c")]
    records = spark.createDataFrame(rows, "pos int, title string, label string")
    data = headlines.build_dataset(records, "pos").cache()
    assert {(r["label"], r["split"]): r["count"] for r in data.groupBy("label", "split").count().collect()} == {("a", "train"): 22, ("a", "test"): 8, ("b", "train"): 22, ("b", "test"): 8}
    assert data.where("title = 'River stone number1'").first()["label"] == "a"
    models = headlines.train_models(data.where("split = 'train'"))
    save_models(models, str(tmp_path / "m"))
    test = data.where("split = 'test'").select("pos", "title", "label")
    first, again = (headlines.evaluate(m, test).collect() for m in (models, load_models(spark, str(tmp_path / "m"), ["majority", "tfidf_logreg"])))
    assert [r.asDict(True) for r in first] == [r.asDict(True) for r in again]
    by = {r["model"]: r for r in first}
    assert by["tfidf_logreg"]["accuracy"] == 1.0 and by["majority"]["accuracy"] == 0.5 and by["majority"]["macro_recall"] == 0.5
    assert [tuple(c) for c in by["majority"]["confusion"]] == [("a", "a", 8), ("a", "b", 0), ("b", "a", 8), ("b", "b", 0)]


def test_change_classes_cross_ranges_of_ids(spark, monkeypatch):
    from sparkloom.operators import ledger

    rng = random.Random(3)
    rows = [(i, rng.choice(["u", "v", None]), rng.choice("ABx")) for i in range(120)]
    df = spark.createDataFrame([(i, k, "error" if s == "x" else "success", None if s == "x" else s) for i, k, s in rows], "id int, k string, status string, sha string")
    want, before = {}, {}
    for i, k, s in rows:
        want[i] = None if s == "x" else "NEW" if k not in before else "UNCHANGED" if before[k] == s else "CHANGED"
        before |= {} if s == "x" else {k: s}
    for size in (1 << 20, 7):
        monkeypatch.setattr(ledger, "RANGE_IDS", size)
        got = ledger.change_class(df, ["k"], "sha")
        assert {r["id"]: r["classification"] for r in got.collect()} == want and got.columns == [*df.columns, "classification"]


def test_a_hot_key_over_many_ranges_keeps_its_columns(spark, monkeypatch):
    from sparkloom.operators import ledger

    monkeypatch.setattr(ledger, "RANGE_IDS", 5)
    df = spark.range(4000).select("id", F.lit("hot").alias("key"), F.lit("success").alias("status"), (F.col("id") / 500).cast("int").cast("string").alias("sha"), F.lit("mine").alias("range"), F.lit(1).alias("last"), F.lit(2).alias("own"))
    got = ledger.change_class(df, ["key"], "sha")
    assert got.columns == [*df.columns, "classification"]
    assert {r["classification"]: r["count"] for r in got.groupBy("classification").count().collect()} == {"NEW": 1, "CHANGED": 7, "UNCHANGED": 3992}
    assert got.where("range = 'mine' and last = 1 and own = 2").count() == 4000
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert len(joins) == 1 and "<" not in joins[0].replace("<=>", "") and ">" not in joins[0].replace("<=>", "")
