"""Feeds as a Spark data source: ``spark.read.format("rss")`` and ``spark.readStream.format("rss")``.

A feed is a partition. A stream's offset is the number of a poll; what a poll fetched is spooled in a
shared folder before its rows go on, so that a micro-batch which is repeated gives the same rows without
another fetch. stream_feeds() keeps the items seen in Spark's state, so that no item comes twice.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from sparkloom.sources.files import HEADLINE, feed_items

#: Seconds between polls of a stream.
EVERY = 300


@dataclass
class Feed(InputPartition):
    """One feed, and in a stream the poll it is read for."""

    label: str
    url: str
    poll: int | None = None


def _stamp(seconds: float) -> str:
    return datetime.fromtimestamp(seconds, UTC).isoformat(timespec="seconds")


def _rows(label: str, body: bytes, at: str) -> Iterator[tuple[str, str, str, str, str, str]]:
    return ((title, label, source, published, link, at) for title, source, published, link in feed_items(body) if title)


def _listed(options: dict[str, str]) -> list[Feed]:
    """Option feeds: a JSON list of objects with label and url; a URL listed twice under a label is read once."""
    listed = json.loads(options.get("feeds") or "[]")
    if not isinstance(listed, list) or any(not isinstance(f, dict) or not isinstance(f.get("label"), str) or not isinstance(f.get("url"), str) for f in listed):
        raise ValueError("option feeds must be a JSON list of objects with label and url")
    return [Feed(label, url) for label, url in dict.fromkeys((f["label"], f["url"]) for f in listed)]


class _Reader(DataSourceReader):
    def __init__(self, get: Callable[[str], bytes], feeds: list[Feed], at: str):
        self.get, self.feeds, self.at = get, feeds, at

    def partitions(self) -> list[InputPartition]:
        return self.feeds

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return _rows(partition.label, self.get(partition.url), self.at) if partition is not None else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, get: Callable[[str], bytes], feeds: list[Feed], spool: str, every: float, clock: Callable[[], float]):
        self.get, self.feeds, self.spool, self.every, self.clock = get, feeds, spool.rstrip("/"), every, clock

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.spool if "://" in self.spool else f"file://{self.spool}")

    def initialOffset(self) -> dict:
        return {"poll": -1}

    def latestOffset(self) -> dict:
        return {"poll": int(self.clock() // self.every)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """A feed says what is in it now, so that a batch over several polls reads it once, for the last."""
        return [Feed(f.label, f.url, end["poll"]) for f in self.feeds]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return _rows(partition.label, self._body(partition), _stamp(partition.poll * self.every))

    def _body(self, feed: Feed) -> bytes:
        from pyarrow import fs

        files, root = self._files()
        folder = f"{root}/{feed.poll}"
        place = f"{folder}/{hashlib.sha256(feed.url.encode()).hexdigest()}"
        if files.get_file_info(place).type == fs.FileType.File:
            with files.open_input_stream(place) as kept:
                return kept.read()
        body = self.get(feed.url)
        files.create_dir(folder, recursive=True)
        beside = f"{place}.{uuid.uuid4().hex}"
        with files.open_output_stream(beside) as out:
            out.write(body)
        files.move(beside, place)
        return body

    def commit(self, end: dict) -> None:
        """Bodies of polls before the finished one aren't read again."""
        from pyarrow import fs

        files, root = self._files()
        for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.type == fs.FileType.Directory and info.base_name.isdigit() and int(info.base_name) < end["poll"]:
                files.delete_dir(info.path)


def feed_source(get: Callable[[str], bytes], clock: Callable[[], float] = time.time) -> type[DataSource]:
    """The data source "rss" over a getter, which returns a feed's bytes or raises (a raise fails the read).

    Options: feeds (JSON list of label and url); fetchedAt (batch: what the rows are stamped with); spool
    (stream: a folder that driver and executors share) and every (stream: seconds between polls).
    Items without a title are dropped, repeats within a feed are kept; no feeds give no rows.
    """

    class Feeds(DataSource):
        @classmethod
        def name(cls) -> str:
            return "rss"

        def schema(self) -> str:
            return HEADLINE

        def reader(self, schema) -> DataSourceReader:
            return _Reader(get, _listed(self.options), self.options.get("fetchedat") or _stamp(clock()))

        def streamReader(self, schema) -> DataSourceStreamReader:
            every = float(self.options.get("every") or EVERY)
            if not self.options.get("spool") or every <= 0:
                raise ValueError("a stream of feeds needs the option spool, and every above 0")
            return _Stream(get, _listed(self.options), self.options["spool"], every, clock)

    return Feeds


def stream_feeds(spark: SparkSession, feeds: list[tuple[str, str]], spool: str, every: float = EVERY) -> DataFrame:
    """A stream of the items of feeds (label, url), each (label, link, title) once, as first seen; needs feed_source() registered.

    Seen items are Spark's state, by key, and grow with the distinct items.
    """
    listed = json.dumps([{"label": label, "url": url} for label, url in feeds])
    rows = spark.readStream.format("rss").options(feeds=listed, spool=spool, every=str(every)).load()
    return rows.dropDuplicates(["label", "link", "title"])
