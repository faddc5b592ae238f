"""Fetching by hosts as a stream: delays, overlap of waits, robots.txt once, restarts."""

import json
import time
import uuid

import pytest

DELAY = 1.0


def getter(log):
    """Answers every page of hosts a, b and c; writes down what was asked, and when."""
    from sparkloom.sources.web import Answer

    def get(url):
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            json.dump([url, time.time()], f)
        if url.endswith("/robots.txt"):
            return Answer(200, {"Content-Type": "text/plain"}, [b"User-agent: *\nDisallow: /private"], "utf-8")
        return Answer(200, {"Content-Type": "text/html"}, [url.encode()], "utf-8")

    return get


def asked(log):
    return sorted((json.loads(f.read_text()) for f in log.iterdir()), key=lambda x: x[1])


@pytest.fixture(scope="module")
def registry(spark):
    rows = [(h, True, True, [f"{h}.example.org"], [], [f"https://{h}.example.org/"]) for h in "abc"]
    return spark.createDataFrame(rows, "id string, enabled boolean, official boolean, domains array<string>, entrypoints array<string>, allowed_url_prefixes array<string>")


def run(spark, registry, tmp_path, n):
    """Runs the stream over the files of a folder until it has made n rows in all."""
    from sparkloom.sources.polite import STATE_STORE, fetch_stream
    from sparkloom.sources.web import FETCHED

    before = {k: spark.conf.get(k, None) for k in (*STATE_STORE, "spark.sql.shuffle.partitions")}
    for k, v in (STATE_STORE | {"spark.sql.shuffle.partitions": "1"}).items():  # all hosts in one task
        spark.conf.set(k, v)
    try:
        urls = spark.readStream.schema("source_id string, url string").json(str(tmp_path / "in"))
        out = fetch_stream(urls, registry, getter(tmp_path / "log"), delay=DELAY).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="200 milliseconds").start(str(tmp_path / "out"))
        until = time.time() + 90
        while time.time() < until and out.exception() is None and (not (tmp_path / "out" / "_spark_metadata").exists() or spark.read.schema(FETCHED).parquet(str(tmp_path / "out")).count() < n):
            time.sleep(0.5)
        out.stop()
        assert out.exception() is None, out.exception()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(FETCHED).parquet(str(tmp_path / "out")).collect()


def test_waits_overlap_and_state_outlives_a_restart(spark, registry, tmp_path):
    for d in ("in", "log"):
        (tmp_path / d).mkdir()
    page = lambda h, p: {"source_id": h, "url": f"https://{h}.example.org/{p}"}
    first = [page(h, p) for h in "abc" for p in ("1", "2", "3")] + [page("a", "private/x"), {"source_id": "a", "url": None}, {"source_id": "no", "url": "https://a.example.org/1"}, {"source_id": "a", "url": "https://b.example.org/1"}]
    (tmp_path / "in" / "one.json").write_text("\n".join(json.dumps(x) for x in first))
    rows = run(spark, registry, tmp_path, len(first))
    assert len(rows) == len(first)
    good = {(r["source_id"], r["url"]): r["text"] for r in rows if r["error"] is None}
    assert good == {(h, f"https://{h}.example.org/{p}"): f"https://{h}.example.org/{p}" for h in "abc" for p in "123"}
    errors = sorted(r["error"] for r in rows if r["error"])
    assert errors == ["URL is outside source fetch policy: None", "URL is outside source fetch policy: https://a.example.org/1", "URL is outside source fetch policy: https://b.example.org/1", "robots.txt disallows: https://a.example.org/private/x"]

    calls = asked(tmp_path / "log")
    by_host = {h: [t for url, t in calls if f"//{h}." in url] for h in "abc"}
    assert all(len(v) == 4 for v in by_host.values())  # robots.txt once, three pages
    assert min(b - a for v in by_host.values() for a, b in zip(v, v[1:], strict=False)) >= DELAY
    spans = {h: (min(v), max(v)) for h, v in by_host.items()}
    assert all(spans[x][0] < spans[y][1] for x in "abc" for y in "abc")  # each host's first request comes before any other's last

    (tmp_path / "in" / "two.json").write_text("\n".join(json.dumps(page(h, "4")) for h in "ab"))
    rows = run(spark, registry, tmp_path, len(first) + 2)
    assert sum(r["error"] is None for r in rows) == 11
    again = [url for url, _ in asked(tmp_path / "log")[len(calls) :]]
    assert sorted(again) == ["https://a.example.org/4", "https://b.example.org/4"]  # robots.txt is remembered


def test_refuses_a_negative_delay(spark, registry):
    from sparkloom.sources.polite import fetch_stream

    with pytest.raises(ValueError, match="delay"):
        fetch_stream(spark.createDataFrame([], "source_id string, url string"), registry, None, delay=-1)
