"""Whether all is ready, what state each source is in, and whether its entrypoints can be reached."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators.acquire import discover_links, run_states
from sparkloom.operators.registry import RegistryError, enabled_sources, source_counts
from sparkloom.operators.store import State, StateError
from sparkloom.sources.html import EXTRACTOR
from sparkloom.sources.web import AGENT, DELAY, Answer, fetch_pages

#: The version of the extractor that artifacts are pinned to.
PINNED = {"name": "sparkloom-text", "version": "2"}
CHECK = "name string, status string, detail string"


def extractor_check(extractor: dict[str, str] = EXTRACTOR) -> tuple[str, str, str]:
    """Whether the extractor is the pinned one."""
    ok = extractor == PINNED
    return "normalizer", "PASS" if ok else "FAIL", f"{extractor['name']} {extractor['version']}" + ("" if ok else f"; expected {PINNED['name']} {PINNED['version']}")


def doctor(spark: SparkSession, registry_path: str, state_path: str, extractor: dict[str, str] = EXTRACTOR) -> DataFrame:
    """``name, status, detail`` of each local check, without network."""
    from sparkloom.sources.files import read_registry

    checks = []
    try:
        sources, _ = read_registry(spark, registry_path)
        counts = source_counts(sources).first()
        checks.append(("registry", "PASS", f"valid registry with {counts['enabled']} enabled official sources"))
        checks.append(("entrypoints", "PASS" if counts["entrypoints"] else "FAIL", f"{counts['entrypoints']} configured entrypoints across enabled sources"))
    except RegistryError as e:
        checks.append(("registry", "FAIL", str(e)))
    try:
        State(spark, state_path)
        checks.append(("state", "PASS", f"state schema OK: {state_path}"))
    except StateError as e:
        checks.append(("state", "FAIL", str(e)))
    checks.append(extractor_check(extractor))
    return spark.createDataFrame(checks, CHECK)


def all_pass(checks: DataFrame) -> bool:
    return checks.agg(F.coalesce(F.bool_and(F.col("status") == "PASS"), F.lit(True))).first()[0]


def _last(ledger: DataFrame, prefix: str, fields: list[str]) -> DataFrame:
    """The latest observation of each source, whatever its status."""
    packed = ledger.groupBy("source_id").agg(F.max_by(F.struct(*[F.col(c) for c in ("id", "status", *fields)]), "id").alias("o"))
    return packed.select("source_id", F.upper("o.status").alias(f"{prefix}_status"), F.col("o.id").alias(f"{prefix}_id"), *[F.col(f"o.{c}").alias(f"{prefix}_{c}") for c in fields])


def status(state: State, registry: DataFrame) -> DataFrame:
    """A row for each enabled official source: its latest run, ingestion and normalization, or NEVER_RUN.

    Runs and observations of sources that the registry doesn't have are left out.
    """
    sources = enabled_sources(registry).select(F.col("id").alias("source_id"))
    runs = run_states(state).groupBy("source_id").agg(F.max_by(F.struct("run_id", "status", "candidate_count", "new_count", "known_count", "finished_at", "error"), "run_id").alias("r"))
    runs = runs.select("source_id", F.upper("r.status").alias("status"), "r.run_id", "r.candidate_count", "r.new_count", "r.known_count", "r.finished_at", "r.error")
    out = sources.join(runs, "source_id", "left")
    out = out.join(_last(state.read("ingestion"), "ingestion", ["classification", "requested_url", "fetched_at", "sha256", "error"]), "source_id", "left")
    out = out.join(_last(state.read("normalization"), "normalization", ["classification", "requested_url", "normalized_at", "normalized_sha256", "title", "extractor_name", "extractor_version", "error"]), "source_id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("candidate_count", "new_count", "known_count")})
    return out.withColumns({c: F.coalesce(c, F.lit("NEVER_RUN")) for c in ("status", "ingestion_status", "normalization_status")})


def worst(statuses: Column) -> Column:
    """The worst of many: FAIL, then BLOCKED, then PASS, which is also that of none."""
    rank = F.max(F.when(statuses == "FAIL", 2).when(statuses == "BLOCKED", 1).otherwise(0))
    return F.element_at(F.array(F.lit("PASS"), F.lit("BLOCKED"), F.lit("FAIL")), F.coalesce(rank, F.lit(0)) + 1)


def verify_live(registry: DataFrame, get: Callable[[str], Answer], source_id: str | None = None, agent: str = AGENT, delay: float = DELAY, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``source_id, status, candidate_count, detail``: whether the entrypoints of enabled sources can be reached; records nothing.

    A source whose robots.txt forbids an entrypoint is BLOCKED; any other failure is FAIL.
    """
    sources = enabled_sources(registry)
    sources = sources if source_id is None else sources.where(F.col("id") == source_id)
    if source_id is not None and sources.isEmpty():
        raise ValueError(f"unknown or disabled source id: {source_id}")
    entrypoints = sources.select(F.col("id").alias("source_id"), F.explode("entrypoints").alias("url"))
    links = discover_links(fetch_pages(entrypoints, registry, get, agent, delay, sleep).withColumnRenamed("url", "entrypoint"), registry)
    found = links.groupBy("source_id").agg(F.min("error").alias("error"), F.count("url").alias("n"))
    out = sources.select(F.col("id").alias("source_id"), F.size("entrypoints").alias("of")).join(found, "source_id", "left")
    kind = F.when(F.col("error").isNull(), "PASS").when(F.contains(F.lower("error"), F.lit("robots.txt disallows")), "BLOCKED").otherwise("FAIL")
    count = F.when(F.col("error").isNull(), F.coalesce("n", F.lit(0))).otherwise(0).cast("long")
    detail = F.coalesce("error", F.concat(F.col("of").cast("string"), F.lit(" entrypoints reachable under current policy")))
    return out.select("source_id", kind.alias("status"), count.alias("candidate_count"), detail.alias("detail"))
