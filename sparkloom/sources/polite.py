"""Pages as a stream: a host's queue, robots.txt and next time are state, and its waits are timers.

``web.fetch_pages`` keeps a host's delay by sleeping in its task, so that the hosts of a task wait one
after the other. Here a task sleeps for none: a micro-batch makes at most one request for each host
that is due, and a timer brings the host back when its delay is over. The rules of a fetch (policy,
redirects, sizes, types, robots.txt) are those of ``web``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparkloom.functions.urls import resolve
from sparkloom.sources.html import HTML_BYTES
from sparkloom.sources.web import AGENT, DELAY, FETCHED, Answer, FetchError, Policy, get_page, get_robots, robots_place, robots_rules

#: The state store that timers and keyed state need.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: Seconds that an answer for robots.txt is good for.
ROBOTS_SECONDS = 86_400
_NAMES = [x.split()[0] for x in FETCHED.split(", ")]


class _Host(StatefulProcessor):
    """One host: URLs wait in a queue by number; an entry leaves it when its row is made."""

    def __init__(self, get, agent: str, delay: float, limit: int, robots_seconds: float):
        self.get, self.agent, self.delay, self.limit, self.robots_ms = get, agent, delay, limit, int(robots_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.queue = handle.getMapState("queue", "at long", "source_id string, url string")
        self.policies = handle.getMapState("policies", "source_id string", "policy string")
        self.robots = handle.getMapState("robots", "place string", "text string, error string, at long")
        self.ends = handle.getValueState("ends", "head long, tail long, due long, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        head, tail, due, timer = self.ends.get() or (0, 0, 0, 0)
        for frame in rows:
            for source, url, policy in zip(frame["source_id"], frame["url"], frame["policy"], strict=True):
                self.queue.updateValue((tail,), (source, url))
                if source is not None:
                    self.policies.updateValue((source,), (policy,))
                tail += 1
        yield from self._step(head, tail, due, timer, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        head, tail, due, _ = self.ends.get()
        yield from self._step(head, tail, due, 0, timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass

    def _step(self, head: int, tail: int, due: int, timer: int, now: int) -> Iterator[pd.DataFrame]:
        """Entries from the head on until one makes a request; the host is due again a delay after it."""
        made = []
        while head < tail and now >= due:
            source, url = self.queue.getValue((head,))
            row, wait = self._fetched(source, url, now)
            if row is not None:
                made.append(row)
                self.queue.removeKey((head,))
                head += 1
            if wait:
                due = int(time.time() * 1000 + wait * 1000) + 1
                break
        if head < tail and timer < due:
            if timer:
                self.handle.deleteTimer(timer)
            timer = due
            self.handle.registerTimer(timer)
        self.ends.update((head, tail, due, timer))
        if made:
            yield pd.DataFrame(made, columns=_NAMES).astype(object)

    def _fetched(self, source: str | None, url: str | None, now: int) -> tuple[tuple | None, float | None]:
        """The row of an entry, or None if only robots.txt was asked for; and the wait after a request, or None if there was none."""
        asked, wait = False, self.delay
        try:
            known = self.policies.getValue((source,))[0] if source is not None else None
            policy = Policy.of(json.loads(known)) if known else None
            start = resolve(url, url) if policy else None
            if start is None or not policy.page(start):
                raise FetchError(f"URL is outside source fetch policy: {url}")
            place = robots_place(start)
            held = self.robots.getValue((place,)) if self.robots.containsKey((place,)) else None
            if held is None or now - held[2] > self.robots_ms:
                try:
                    answer = (get_robots(self.get, policy, start), None)
                except FetchError as e:
                    answer = (None, str(e))
                self.robots.updateValue((place,), (*answer, now))
                return None, wait
            if held[1] is not None:
                raise FetchError(held[1])
            rules = robots_rules(held[0])
            if rules is not None and not rules.can_fetch(self.agent, start):
                raise FetchError(f"robots.txt disallows: {url}")
            wait = max(wait, float(rules.crawl_delay(self.agent) or 0) if rules is not None else 0.0)
            asked = True
            return (source, url, *get_page(self.get, policy, start, self.limit), None), wait
        except FetchError as e:
            return (source, url, None, None, None, None, None, str(e)), wait if asked else None


def fetch_stream(urls: DataFrame, registry: DataFrame, get: Callable[[str], Answer], agent: str = AGENT, delay: float = DELAY, limit: int = HTML_BYTES, robots_seconds: float = ROBOTS_SECONDS) -> DataFrame:
    """The rows of fetch_pages() for a stream of URLs (``source_id, url``), each as soon as its host allows.

    A request of a host, robots.txt included, comes at least delay (or the Crawl-delay after a page)
    after the one before. A URL that policy or robots.txt forbids makes a row with an error and costs
    no wait; a null URL or an unknown source is forbidden. Repeated URLs are fetched again. The query needs STATE_STORE, a
    checkpoint, and a processing-time trigger: its interval bounds how long after its due time a host is
    served. A batch that is run again after a failure repeats its requests, never its rows: queue, robots.txt
    and due times are as they were. State grows with the URLs that wait, and by a robots.txt a host.
    """
    if delay < 0:
        raise ValueError("delay must be 0 or more")
    policy = F.to_json(F.struct("enabled", "official", "domains", "entrypoints", "allowed_url_prefixes"), {"ignoreNullFields": "false"})
    known = registry.select(F.col("id").alias("source_id"), policy.alias("policy"))
    rows = urls.select("source_id", "url").join(F.broadcast(known), "source_id", "left")
    host = F.lower(F.coalesce(F.regexp_extract("url", "^[A-Za-z]+://([^/?#]+)", 1), F.lit("")))
    return rows.withColumn("host", host).groupBy("host").transformWithStateInPandas(_Host(get, agent, delay, limit, robots_seconds), FETCHED, "append", "processingTime")
