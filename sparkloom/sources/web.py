"""Pages and robots.txt over an injected getter, under a source's policy, one host at a time.

A getter takes a URL and returns an Answer, or raises; it must not follow redirects itself, so that
every hop is checked here. Rows of one host are fetched one after the other by one task, with the
host's robots.txt read once and its delay kept; hosts run in parallel.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from urllib import robotparser
from urllib.parse import urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.urls import resolve
from sparkloom.sources.html import HTML_BYTES, REDIRECTS, ROBOTS_BYTES

#: Answers that redirect, that say there is no robots.txt, types of pages, seconds between fetches.
REDIRECTING, ABSENT, PAGE_TYPES, DELAY = (301, 302, 303, 307, 308), (404, 410), ("text/html", "application/xhtml+xml"), 1.0
AGENT = "sparkloom/1.0"
FETCHED = "source_id string, url string, final_url string, status int, content_type string, body binary, text string, error string"


class FetchError(RuntimeError):
    """A fetch that policy, limits or the answer forbid."""


@dataclass
class Answer:
    """What a getter returns; chunks may be a generator, which is read no further than the limit."""

    status: int
    headers: dict[str, str] = field(default_factory=dict)
    chunks: Iterable[bytes] = ()
    encoding: str | None = None
    close: Callable[[], None] = lambda: None

    def header(self, name: str) -> str:
        return next((v for k, v in self.headers.items() if k.lower() == name), "")


@dataclass(frozen=True)
class Policy:
    """What a source allows."""

    enabled: bool
    official: bool
    domains: frozenset[str]
    entrypoints: frozenset[str]
    prefixes: tuple[str, ...]

    @classmethod
    def of(cls, row) -> Policy:
        strings = lambda x: [str(v) for v in (x if x is not None else [])]
        entrypoints = (resolve(e, e) for e in strings(row["entrypoints"]))
        return cls(row["enabled"] is True or bool(row["enabled"]), bool(row["official"]), frozenset(d.lower() for d in strings(row["domains"])), frozenset(e for e in entrypoints if e), tuple(strings(row["allowed_url_prefixes"])))

    def on_host(self, url: str) -> bool:
        parts = urlsplit(url)
        return parts.scheme == "https" and (parts.hostname or "") in self.domains

    def page(self, url: str) -> bool:
        """A configured entrypoint, or a URL on a listed host under a listed prefix; of an enabled official source."""
        listed = url in self.entrypoints or self.on_host(url) and url.startswith(self.prefixes)
        return self.enabled and self.official and listed

    def robots(self, url: str) -> bool:
        return self.on_host(url) and urlsplit(url).path == "/robots.txt"


def bounded(answer: Answer, limit: int) -> bytes:
    """The body, refused as soon as its declared or actual size exceeds limit."""
    declared = answer.header("content-length")
    if declared.strip().isdigit() and int(declared) > limit:
        raise FetchError(f"response too large: declared {declared} bytes, limit {limit}")
    out = bytearray()
    for chunk in answer.chunks:
        out += chunk
        if len(out) > limit:
            raise FetchError(f"response too large while streaming: limit {limit} bytes")
    return bytes(out)


def decoded(body: bytes, encoding: str | None) -> str:
    """By the declared encoding, or else as UTF-8 with replacements."""
    try:
        return body.decode(encoding or "utf-8")
    except (LookupError, UnicodeDecodeError):
        return body.decode("utf-8", "replace")


def followed(get: Callable[[str], Answer], url: str, allowed: Callable[[str], bool]) -> tuple[str, Answer]:
    """The first answer that doesn't redirect, and its URL; every hop must be allowed."""
    for _ in range(REDIRECTS + 1):
        try:
            answer = get(url)
        except Exception as e:  # noqa: BLE001
            raise FetchError(f"request failed for {url}: {type(e).__name__}") from e
        if answer.status not in REDIRECTING:
            return url, answer
        answer.close()
        location = answer.header("location")
        if not location:
            raise FetchError("redirect without Location")
        target = resolve(url, urljoin(url, location))
        if target is None or not allowed(target):
            raise FetchError(f"redirect target is outside policy: {location}")
        url = target
    raise FetchError("too many redirects")


def _body(get, url: str, allowed, limit: int, types: Callable[[str], bool]) -> tuple[str, Answer, str, bytes]:
    final, answer = followed(get, url, allowed)
    try:
        kind = answer.header("content-type").split(";")[0].strip().lower()
        if not 200 <= answer.status < 300:
            raise FetchError(f"unexpected HTTP status {answer.status} for {final}")
        if not types(kind):
            raise FetchError(f"unexpected content type: {kind or '<missing>'}")
        return final, answer, kind, bounded(answer, limit)
    finally:
        answer.close()


def get_page(get: Callable[[str], Answer], policy: Policy, url: str, limit: int = HTML_BYTES) -> tuple[str, int, str, bytes, str]:
    """``final_url, status, content_type, body, text`` of an HTML page; raises FetchError."""
    start = resolve(url, url)
    if start is None or not policy.page(start):
        raise FetchError(f"URL is outside source fetch policy: {url}")
    final, answer, kind, body = _body(get, start, policy.page, limit, lambda k: k in PAGE_TYPES)
    return final, answer.status, kind, body, decoded(body, answer.encoding)


def robots_place(url: str) -> str:
    parts = urlsplit(url)
    return urlunsplit((parts.scheme, parts.netloc, "/robots.txt", "", ""))


def get_robots(get: Callable[[str], Answer], policy: Policy, url: str, limit: int = ROBOTS_BYTES) -> str | None:
    """The robots.txt for a URL, or None where there is none; any other failure raises FetchError."""
    start = resolve(url, url)
    if start is None or not policy.page(start):
        raise FetchError(f"URL is outside source fetch policy: {url}")
    place = robots_place(start)
    if not policy.robots(place):
        raise FetchError(f"robots.txt is outside source domains: {place}")
    final, answer = followed(get, place, policy.robots)
    if answer.status in ABSENT:
        answer.close()
        return None
    _, answer, _, body = _body(lambda _: answer, final, policy.robots, limit, lambda k: not k or k.startswith("text/"))
    return decoded(body, answer.encoding)


def robots_rules(text: str | None) -> robotparser.RobotFileParser | None:
    if text is None:
        return None
    rules = robotparser.RobotFileParser()
    rules.parse(text.splitlines())
    return rules


class Host:
    """One host's robots.txt, asked for once, and the time of its last fetch."""

    def __init__(self, get, agent: str, delay: float, sleep: Callable[[float], None]):
        self.get, self.agent, self.delay, self.sleep = get, agent, delay, sleep
        self.rules: dict[str, robotparser.RobotFileParser | None | FetchError] = {}

    def page(self, policy: Policy, url: str, limit: int) -> tuple:
        start = resolve(url, url)
        if start is None or not policy.page(start):
            raise FetchError(f"URL is outside source fetch policy: {url}")
        place = robots_place(start)
        if place not in self.rules:
            try:
                self.rules[place] = robots_rules(get_robots(self.get, policy, start))
            except FetchError as e:
                self.rules[place] = e
        rules = self.rules[place]
        if isinstance(rules, FetchError):
            raise rules
        if rules is not None and not rules.can_fetch(self.agent, start):
            raise FetchError(f"robots.txt disallows: {url}")
        wait = max(self.delay, float(rules.crawl_delay(self.agent) or 0) if rules is not None else 0.0)
        if wait > 0:
            self.sleep(wait)
        return get_page(self.get, policy, start, limit)


def fetch_pages(urls: DataFrame, registry: DataFrame, get: Callable[[str], Answer], agent: str = AGENT, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep, limit: int = HTML_BYTES) -> DataFrame:
    """``source_id, url, final_url, status, content_type, body, text, error`` for each row (``source_id, url``).

    Failures are rows with an error and nothing else; URLs of unknown sources fail. A null URL fails.
    """
    if delay < 0:
        raise ValueError("delay must be 0 or more")
    known = registry.select(F.col("id").alias("source_id"), "enabled", "official", "domains", "entrypoints", "allowed_url_prefixes")
    rows = urls.select("source_id", "url").join(F.broadcast(known), "source_id", "left")
    rows = rows.withColumn("host", F.coalesce(F.regexp_extract("url", "^[A-Za-z]+://([^/?#]+)", 1), F.lit("")))
    names = [x.split()[0] for x in FETCHED.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hosts: dict[str, Host] = {}
        for frame in frames:
            for row in frame.to_dict("records"):
                if row["host"] not in hosts:
                    hosts = {row["host"]: Host(get, agent, delay, sleep)}  # rows come by host
                made = (None, None, None, None, None)
                error = None
                try:
                    made = hosts[row["host"]].page(Policy.of(row), row["url"], limit)
                except FetchError as e:
                    error = str(e)
                yield pd.DataFrame([(row["source_id"], row["url"], *made, error)], columns=names).astype(object)

    return rows.repartition("host").sortWithinPartitions("host", "url").mapInPandas(run, FETCHED)
