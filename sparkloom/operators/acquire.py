"""From a registry to normalized documents: discovery, ingestion and normalization over a state.

Each stage reads the state's tables, does its work as one plan over many rows, and appends what
happened, failures included. Ids and change classes come from the ledger as it stood; one writer at
a time appends to a state.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.documents import canonical_text
from sparkloom.functions.provenance import object_path
from sparkloom.functions.text import normal_lines
from sparkloom.functions.urls import is_allowed_candidate, normalize_url
from sparkloom.operators.allowlist import allowed_urls
from sparkloom.operators.blocks import blocks_of
from sparkloom.operators.ledger import candidates, latest
from sparkloom.operators.registry import enabled_sources
from sparkloom.operators.store import ARTIFACT_VERSION, State, StateError, addressed, store_exact, verified_objects
from sparkloom.sources.html import EXTRACTOR, hrefs, page_metadata
from sparkloom.sources.web import AGENT, DELAY, Answer, fetch_pages

URL_KEYS = ["source_id", "requested_url"]
_OPTIONS = {"include_comments": False, "include_links": False, "include_tables": True, "output_format": "markdown"}


def utc_now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def discover_links(pages: DataFrame, registry: DataFrame, html: str = "text") -> DataFrame:
    """``source_id, entrypoint, url, error``: the allowed links of pages (``source_id, entrypoint, final_url``, html, and perhaps error).

    A page must come from a configured entrypoint, and stand there or at an allowed URL; otherwise,
    and if it has an error already, it is one row with an error. Links to the page itself are left
    out, the rest come once each. The HTML of a page is parsed once; links meet prefixes by allowed_urls().
    """
    known = registry.select(F.col("id").alias("source_id"), "enabled", "official", "domains", "entrypoints", "allowed_url_prefixes")
    policy = [F.col(c) for c in ("enabled", "official", "domains", "allowed_url_prefixes")]
    own = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    rows = pages.select("source_id", "entrypoint", F.coalesce("final_url", "entrypoint").alias("base"), F.col(html).alias("html"), own.alias("failed"))
    rows = rows.join(F.broadcast(known), "source_id", "left")
    rows = rows.withColumns({"base": normalize_url("base", "base"), "origin": normalize_url("entrypoint", "entrypoint")})
    listed = F.coalesce(F.array_contains("entrypoints", F.col("entrypoint")), F.lit(False))
    outside = (F.col("base") != F.col("origin")) & ~is_allowed_candidate(F.col("base"), *policy)
    error = F.when(F.col("failed").isNotNull(), F.col("failed")).when(~listed, "entrypoint is not configured").when(F.col("base").isNull(), "invalid base URL").when(outside, "base URL is outside source policy")
    rows = rows.withColumn("error", error)
    failed = rows.where(F.col("error").isNotNull()).select("source_id", "entrypoint", F.lit(None).cast("string").alias("url"), "error")
    found = rows.where(F.col("error").isNull()).select("source_id", "entrypoint", "base", "origin", F.explode(hrefs("html")).alias("href"))
    found = found.withColumn("url", normalize_url("base", "href")).where((F.col("url") != F.col("base")) & (F.col("url") != F.col("origin")))
    links = allowed_urls(found.select("source_id", "entrypoint", "url").distinct(), registry)
    return links.withColumn("error", F.lit(None).cast("string")).unionByName(failed.distinct())


def discover(state: State, registry: DataFrame, get: Callable[[str], Answer], source_id: str | None = None, agent: str = AGENT, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """One run for each enabled official source (or one of them): fetch its entrypoints, record what they link to.

    A run succeeds only if all entrypoints of its source do; otherwise it is recorded as failed, with
    the first reason, and its sightings aren't. Returns the rows of run_states() of these runs.
    """
    spark = state.spark
    sources = enabled_sources(registry)
    sources = sources if source_id is None else sources.where(F.col("id") == source_id)
    first = state.next_id("runs", "run_id")
    runs = [(first + i, r["id"]) for i, r in enumerate(sources.select("id").orderBy("id").collect())]
    if not runs:
        raise StateError(f"no enabled official source {source_id or ''}")
    started = spark.createDataFrame([(n, s, "started", utc_now(), None) for n, s in runs], "run_id long, source_id string, event string, at string, error string")
    state.append("runs", started)
    urls = sources.select(F.col("id").alias("source_id"), F.explode("entrypoints").alias("url"))
    where = f"{state.path}/pages-{first}"
    fetch_pages(urls, registry, get, agent, delay, sleep).write.parquet(where)  # pages are fetched once, whatever follows
    found = discover_links(spark.read.parquet(where).withColumnRenamed("url", "entrypoint"), registry)
    numbered = found.join(F.broadcast(spark.createDataFrame(runs, "run_id long, source_id string")), "source_id", "right")
    errors = numbered.groupBy("run_id", "source_id").agg(F.min_by("error", F.struct(F.col("error").isNull(), "entrypoint")).alias("error"))
    now = F.lit(utc_now())
    good = numbered.join(errors.where("error is null").select("run_id"), "run_id", "left_semi").where("url is not null")
    state.append("sightings", good.select("run_id", "source_id", "entrypoint", "url", now.alias("at")))
    state.append("runs", errors.select("run_id", "source_id", F.when(F.col("error").isNull(), "success").otherwise("error").alias("event"), now.alias("at"), "error"))
    return run_states(state).where(F.col("run_id") >= first)


def run_states(state: State) -> DataFrame:
    """A row for each discovery run: ``run_id, source_id, started_at, finished_at, status, candidate_count, new_count, known_count, error``."""
    ended = F.col("event") != "started"
    runs = state.read("runs").groupBy("run_id", "source_id").agg(
        F.min(F.when(~ended, F.col("at"))).alias("started_at"), F.min_by(F.when(ended, F.struct("event", "at", "error")), F.when(ended, F.col("at"))).alias("end")
    )
    seen = state.read("sightings").select("run_id", "source_id", "url").distinct()
    first = F.min("run_id").over(Window.partitionBy("source_id", "url"))
    counts = seen.withColumn("new", F.col("run_id") == first).groupBy("run_id").agg(F.count("*").alias("n"), F.count_if("new").alias("new"))
    out = runs.join(counts, "run_id", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "run_id", "source_id", "started_at", F.col("end.at").alias("finished_at"), F.coalesce("end.event", F.lit("running")).alias("status"), n(F.col("n")).alias("candidate_count"),
        n(F.col("new")).alias("new_count"), (n(F.col("n")) - n(F.col("new"))).alias("known_count"), F.col("end.error").alias("error"),
    )


def run_violations(state: State) -> DataFrame:
    """``run_id, started, ended`` of runs that weren't started once or ended more than once."""
    counts = state.read("runs").groupBy("run_id").agg(F.count_if(F.col("event") == "started").alias("started"), F.count_if(F.col("event") != "started").alias("ended"))
    return counts.where("started <> 1 or ended > 1")


def finish_run(state: State, run_id: int, error: str | None = None) -> None:
    """Ends a run by hand; raises StateError unless it is running."""
    row = run_states(state).where(F.col("run_id") == run_id).first()
    if row is None or row["status"] != "running":
        raise StateError(f"run {run_id} is not running")
    state.append("runs", state.spark.createDataFrame([(run_id, row["source_id"], "error" if error else "success", utc_now(), error)], "run_id long, source_id string, event string, at string, error string"))


def candidate_documents(state: State) -> DataFrame:
    """``source_id, url, first_seen_at, last_seen_at, seen_count`` of every discovered URL."""
    once = state.read("sightings").groupBy("source_id", "url", "run_id").agg(F.min("at").alias("at"))
    return candidates(once, ["source_id", "url"], "run_id", "at")


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    if limit is not None and limit < 1:
        raise ValueError("limit must be 1 or more")
    return df if limit is None else df.limit(limit)


def candidate_urls(state: State, source_id: str, limit: int | None = None) -> DataFrame:
    """A source's discovered URLs, oldest first, then by URL."""
    rows = candidate_documents(state).where(F.col("source_id") == source_id)
    return _limited(rows.orderBy("first_seen_at", "url"), limit).select("source_id", "url")


def undiscovered(state: State, urls: DataFrame) -> DataFrame:
    """The rows of urls (``source_id, url``) that no run has seen; must be empty for them to be ingested."""
    return urls.join(state.read("sightings").select("source_id", "url").distinct(), ["source_id", "url"], "left_anti")


def classified(new: DataFrame, ledger: DataFrame, keys: list[str], sha: str) -> DataFrame:
    """new (one row a key) with classification against the key's latest success in the ledger; null for failures."""
    last = latest(ledger.where("status = 'success'"), keys).select(*keys, F.col(sha).alias("_before"))
    kind = F.when(F.col("_before").isNull(), "NEW").when(F.col("_before") == F.col(sha), "UNCHANGED").otherwise("CHANGED")
    return new.join(last, keys, "left").withColumn("classification", F.when(F.col("status") == "success", kind)).drop("_before")


def numbered(rows: DataFrame, first: int, order: list[str], path: str) -> DataFrame:
    """rows with id, from first on without gaps in the order of columns; written to path, which the result reads.

    The files are ranges of the order, sorted within. A row's id is its place in its file after the
    rows of all files before it: only a count for each file meets in one task.
    """
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    made = rows.sparkSession.read.schema(rows.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    part = [F.regexp_extract("_file", p, 1).cast("long") for p in (r"^part-(\d+)", r"-c(\d+)")]
    files = made.groupBy("_file").agg(F.count("*").alias("_rows"))
    starts = files.select("_file", (F.sum("_rows").over(Window.orderBy(*part)) - F.col("_rows")).alias("_start"))
    return made.join(F.broadcast(starts), "_file").withColumn("id", F.col("_start") + F.col("_place") + first).drop("_file", "_place", "_start")


def ingest(state: State, registry: DataFrame, urls: DataFrame, get: Callable[[str], Answer], agent: str = AGENT, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Fetch discovered URLs (``source_id, url``), store their exact bytes, record every outcome; returns the new observations.

    Raises StateError, and records nothing, for a URL that wasn't discovered or a source that isn't
    enabled and official. A failed fetch is an error row and doesn't stop the others.
    """
    urls = urls.select("source_id", "url").distinct()
    strange = undiscovered(state, urls).unionAll(urls.join(enabled_sources(registry).select(F.col("id").alias("source_id")), "source_id", "left_anti")).first()
    if strange:
        raise StateError(f"not a discovered URL of an enabled official source: {strange['source_id']}: {strange['url']}")
    where = f"{state.path}/fetched-{utc_now().replace(':', '')}-{state.next_id('ingestion')}"
    fetch_pages(urls, registry, get, agent, delay, sleep).write.parquet(where)  # pages are fetched once, whatever follows
    pages = state.spark.read.parquet(where)
    store_exact(state, "objects", addressed(pages.where("error is null")))
    sha = F.when(F.col("error").isNull(), F.sha2("body", 256))
    rows = pages.select(
        "source_id", F.col("url").alias("requested_url"), "final_url", F.lit(utc_now()).alias("fetched_at"), F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"),
        "content_type", F.octet_length("body").cast("long").alias("bytes_read"), sha.alias("sha256"), object_path(sha).alias("object_path"), "error",
    )
    return _recorded(state, "ingestion", classified(rows, state.read("ingestion"), URL_KEYS, "sha256"))


def _recorded(state: State, name: str, rows: DataFrame) -> DataFrame:
    first = state.next_id(name)
    state.append(name, numbered(rows, first, URL_KEYS, f"{state.path}/numbered/{name}-{first}-{uuid.uuid4().hex}"))
    return state.read(name).where(F.col("id") >= first)


def latest_ingestions(state: State, source_id: str, limit: int | None = None) -> DataFrame:
    """A source's latest successful ingestion of each URL, by time, then URL."""
    rows = latest(state.read("ingestion").where((F.col("status") == "success") & (F.col("source_id") == source_id)), URL_KEYS)
    return _limited(rows.orderBy("fetched_at", "requested_url"), limit)


def extracted(pages: DataFrame, html: str, url: str | None = None) -> DataFrame:
    """Adds artifact (a struct, fields in alphabetical order) and artifact_error to pages."""
    rows = page_metadata(pages, html, url).withColumn("_markdown", normal_lines(F.col("page.markdown")))
    rows = rows.withColumn("_blocks", blocks_of(F.col("_markdown")))
    extractor = F.struct(F.lit(EXTRACTOR["name"]).alias("name"), F.struct(*[F.lit(v).alias(k) for k, v in sorted(_OPTIONS.items())]).alias("options"), F.lit(EXTRACTOR["version"]).alias("version"))
    metadata = F.struct(*[F.col(f"page.{c}").alias(c) for c in ("authors", "declared_canonical_url", "description", "language", "modified_at", "published_at", "site_name", "title")])
    artifact = F.struct(F.col("_blocks").alias("blocks"), extractor.alias("extractor"), F.col("_markdown").alias("markdown"), metadata.alias("metadata"), F.lit(ARTIFACT_VERSION).cast("long").alias("schema_version"))
    error = F.when(F.coalesce(F.size("_blocks"), F.lit(0)) == 0, "extractor returned no usable main content")
    return rows.withColumns({"artifact_error": error, "artifact": F.when(error.isNull(), artifact)}).drop("page", "_markdown", "_blocks")


def normalize(state: State, ingestions: DataFrame) -> DataFrame:
    """Normalize successful ingestions from their verified bytes, store the artifacts, record every outcome; returns the new observations."""
    rows = verified_objects(ingestions, state.read("objects"))
    text = F.when(F.col("error").isNull(), F.make_valid_utf8(F.col("body").cast("string")))
    made = extracted(rows.withColumn("_text", text).drop("body"), "_text", "final_url")
    made = made.withColumn("error", F.coalesce("error", "artifact_error")).withColumn("_json", F.when(F.col("error").isNull(), canonical_text(F.col("artifact"))))
    store_exact(state, "artifacts", addressed(made.select(F.col("_json").cast("binary").alias("body")), root="normalized", suffix=".json"))
    sha = F.sha2("_json", 256)
    out = made.select(
        "source_id", "requested_url", F.col("id").alias("ingestion_observation_id"), F.col("sha256").alias("raw_sha256"), F.lit(EXTRACTOR["name"]).alias("extractor_name"), F.lit(EXTRACTOR["version"]).alias("extractor_version"),
        F.lit(utc_now()).alias("normalized_at"), F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"), sha.alias("normalized_sha256"), object_path(sha, "normalized", ".json").alias("artifact_path"),
        F.when(F.col("error").isNull(), F.col("artifact.metadata.title")).alias("title"), F.when(F.col("error").isNull(), F.size("artifact.blocks")).cast("long").alias("block_count"), F.length("artifact.markdown").cast("long").alias("char_count"), "error",
    )
    return _recorded(state, "normalization", classified(out, state.read("normalization"), [*URL_KEYS, "extractor_name", "extractor_version"], "normalized_sha256"))


def stage_summary(observations: DataFrame, by: Column | str = "source_id") -> DataFrame:
    """``processed, new_count, unchanged_count, changed_count, error_count, ok`` of a stage's new observations."""
    n = lambda c: F.count_if(F.col("classification") == c).alias(f"{c.lower()}_count")
    out = observations.groupBy(by).agg(F.count("*").alias("processed"), n("NEW"), n("UNCHANGED"), n("CHANGED"), F.count_if(F.col("status") == "error").alias("error_count"))
    return out.withColumn("ok", F.col("error_count") == 0)
