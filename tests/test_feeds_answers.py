"""Feeds as a data source, and providers whose answers outlive a job."""

import hashlib
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import answers
from sparkloom.sources.feeds import feed_source, stream_feeds


def rss(*items):
    body = "".join(f"<item><title>{t}</title><link>{u}</link><pubDate>d</pubDate></item>" for t, u in items)
    return f"<rss><channel>{body}</channel></rss>".encode()


@pytest.fixture
def feeds(spark, tmp_path):
    """A folder of feeds by name, fetches as files in calls/, and a clock in the file now."""
    root = str(tmp_path)
    os.mkdir(f"{root}/calls")

    def get(url):
        open(f"{root}/calls/{url}-{uuid.uuid4().hex}", "w").close()
        with open(f"{root}/{url}", "rb") as f:
            return f.read()

    def clock():
        with open(f"{root}/now") as f:
            return float(f.read())

    (tmp_path / "now").write_text("1000")
    spark.dataSource.register(feed_source(get, clock))
    return tmp_path


def test_feeds_are_read_a_partition_each(spark, feeds):
    (feeds / "one").write_bytes(rss((" A ", "l1"), ("", "l2"), ("A", "l1")))
    (feeds / "two").write_bytes(rss(("é &amp; B", "l3")))
    listed = [{"label": "x", "url": "one"}, {"label": "y", "url": "two"}, {"label": "x", "url": "one"}]
    read = spark.read.format("rss").option("fetchedAt", "t")
    df = read.option("feeds", json.dumps(listed)).load()
    assert sorted(map(tuple, df.collect())) == [("A", "x", "unknown", "d", "l1", "t"), ("A", "x", "unknown", "d", "l1", "t"), ("é & B", "y", "unknown", "d", "l3", "t")]
    assert df.rdd.getNumPartitions() == 2
    assert read.option("feeds", "[]").load().count() == 0
    with pytest.raises(Exception, match="JSON list"):
        read.option("feeds", '{"a": 1}').load().count()
    (feeds / "one").write_bytes(b"no feed")
    with pytest.raises(Exception, match="not XML"):
        df.count()


def test_a_repeated_batch_gives_its_rows_again_and_none_twice(spark, feeds):
    seen = []

    def run():
        stream = stream_feeds(spark, [("x", "one")], str(feeds / "spool"), every=100)
        sink = lambda df, n: seen.append((n, sorted((r["title"], r["fetched_at"][14:]) for r in df.collect())))
        query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(feeds / "checkpoint")).trigger(availableNow=True).start()
        assert query.awaitTermination(90)

    (feeds / "one").write_bytes(rss(("A", "1"), ("B", "2"), ("A", "1")))
    run()
    (feeds / "one").write_bytes(rss(("B", "2"), ("C", "3")))
    (feeds / "now").write_text("1234")
    run()
    assert seen == [(0, [("A", "16:40+00:00"), ("B", "16:40+00:00")]), (1, [("C", "20:00+00:00")])]
    fetched = len(os.listdir(feeds / "calls"))
    for name in ("1", ".1.crc"):
        (feeds / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    (feeds / "one").write_bytes(rss(("other", "9")))  # the feed has moved on; the batch that never finished has not
    run()
    assert seen[2] == seen[1] and len(seen) == 3 and len(os.listdir(feeds / "calls")) == fetched == 2


def requests_of(spark, n):
    rows = [(i, json.dumps({"n": i % n}), None) for i in range(2 * n)] + [(-1, "never", "bad bundle"), (-2, None, None)]
    return spark.createDataFrame(rows, "response_of int, request string, error string").withColumn("request_sha256", F.lit("mine"))


def test_a_killed_job_repeats_no_kept_answer(spark, tmp_path):
    calls, store = tmp_path / "calls", str(tmp_path / "answers")
    calls.mkdir()
    folder = str(calls)

    def provider(text, dies=False):
        if dies and len(os.listdir(folder)) >= 7:
            os._exit(1)
        n = json.loads(text)["n"]
        open(f"{folder}/{n}-{uuid.uuid4().hex}", "w").close()
        if n == 3:
            raise KeyError("secret")
        return f"answer\n{n} é"

    asked = requests_of(spark, 20)
    with pytest.raises(Exception, match="exited unexpectedly|Python worker"):
        answers.run_kept(asked, lambda t: provider(t, True), store, in_flight=1)
    kept = {r["request_sha256"] for r in answers.kept_answers(spark, store).collect()}
    first = {f.split("-")[0] for f in os.listdir(folder)}
    assert 0 < len(kept) <= len(first) < 20
    for made in (answers.run_kept(asked, provider, store, in_flight=4), answers.run_kept(asked, provider, store)):
        assert made.columns == ["response_of", "request", "request_sha256", "error", "response"]
        rows = {r["response_of"]: r for r in made.collect()}
        assert len(rows) == 42 and {r["request_sha256"] for r in rows.values()} == {"mine"}
        assert all(rows[i]["response"] == f"answer\n{i % 20} é" for i in range(40) if i % 20 != 3)
        assert rows[3]["error"] == rows[23]["error"] == "provider execution failed (KeyError)" and rows[3]["response"] is None
        assert (rows[-1]["error"], rows[-1]["response"], rows[-2]["error"], rows[-2]["response"]) == ("bad bundle", None, None, None)
    names = [f.split("-")[0] for f in os.listdir(folder)]
    once = [n for n in map(str, range(20)) if n not in first or hashlib.sha256(json.dumps({"n": int(n)}).encode()).hexdigest() in kept]
    assert len(once) >= 16 and all(names.count(n) == 1 for n in once) and set(names) == set(map(str, range(20)))  # only what was under way comes again
    calls_made = len(names)

    answers.compact(spark, store)
    answers.compact(spark, store)
    assert not os.path.exists(f"{store}/single") and answers.kept_answers(spark, store).count() == 20
    again = answers.run_kept(asked, lambda t: "late", store, retry_errors=True)
    assert {r["response"] for r in again.where("response_of in (3, 23)").collect()} == {"late"} and again.where("error is not null").count() == 1
    assert len(os.listdir(folder)) == calls_made and answers.kept_answers(spark, store).count() == 20
    with pytest.raises(ValueError):
        answers.run_kept(asked, provider, store, in_flight=0)
