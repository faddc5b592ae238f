"""The source registry: which sources there are, what they allow, and all that is wrong with one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.functions.urls import host_of
from sparkloom.operators.ledger import violations

_SOURCE = "struct<id:string,organization:string,organization_types:array<string>,source_type:string,official:boolean,enabled:boolean,domains:array<string>,entrypoints:array<string>,allowed_url_prefixes:array<string>,topics:array<string>>"
_HEAD = "struct<schema_version:bigint,default:string,discovery_defaults:struct<scope:string,same_domain_only:boolean>>"


class RegistryError(ValueError):
    """The registry breaks its trust contract."""


def sources_of(spark: SparkSession, text: str) -> DataFrame:
    """A row for each source, with its place in the registry."""
    rows = spark.createDataFrame([(text,)], "text string").select(F.from_json("text", f"struct<sources:array<{_SOURCE}>>").alias("r"))
    return rows.select(F.posexplode("r.sources").alias("place", "s")).select("place", "s.*")


def _is_absolute_https(url: Column) -> Column:
    return url.startswith("https://") & host_of(url).isNotNull()


def _listed(urls: Column) -> Column:
    known = F.transform("domains", F.lower)
    return F.forall(urls, lambda u: F.coalesce(_is_absolute_https(u) & F.array_contains(known, host_of(u)), F.lit(False)))


def source_rules() -> list[tuple[str, Column]]:
    """Rules over the rows of sources_of() with nth, the number of the row among those of its id."""
    filled = lambda c: F.size(F.coalesce(c, F.array())) > 0
    return [
        ("id must be a non-empty string", F.trim("id") != ""),
        ("duplicate source id", (F.col("nth") == 1) | F.col("id").isNull()),
        ("enabled sources must be official", ~F.coalesce("enabled", F.lit(False)) | F.col("official")),
        ("domains must be a non-empty list", filled(F.col("domains"))),
        ("entrypoints must be a non-empty list", filled(F.col("entrypoints"))),
        ("allowed_url_prefixes must be a non-empty list", filled(F.col("allowed_url_prefixes"))),
        ("entrypoint must be HTTPS on a listed domain", F.coalesce(_listed(F.coalesce("entrypoints", F.array().cast("array<string>"))), F.lit(False))),
        ("allowed_url_prefix must be HTTPS on a listed domain", F.coalesce(_listed(F.coalesce("allowed_url_prefixes", F.array().cast("array<string>"))), F.lit(False))),
    ]


def head_rules() -> list[tuple[str, Column]]:
    """Rules over the registry itself."""
    h = F.col("h")
    return [
        ("schema_version must be 1", h["schema_version"] == 1),
        ("default trust policy must be 'deny'", h["default"] == "deny"),
        ("discovery_defaults.scope must be 'entrypoint_links_only'", h["discovery_defaults"]["scope"] == "entrypoint_links_only"),
        ("discovery_defaults.same_domain_only must be true", h["discovery_defaults"]["same_domain_only"]),
        ("sources must be a non-empty list", F.col("n") > 0),
    ]


def registry_violations(sources: DataFrame) -> DataFrame:
    """``entity_id, rule_no, message`` for each broken rule of a source; entity_id is its id, or its place."""
    numbered = sources.withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("place")))
    entity = F.coalesce(F.nullif(F.trim("id"), F.lit("")), F.concat(F.lit("sources["), F.col("place").cast("string"), F.lit("]")))
    return violations(numbered, entity, source_rules())


def registry_errors(spark: SparkSession, text: str) -> DataFrame:
    """``place, rule_no, message``: everything that is wrong with a registry's text; place -1 is the registry itself."""
    sources = sources_of(spark, text)
    head = spark.createDataFrame([(text,)], "text string").select(F.from_json("text", _HEAD).alias("h"), F.coalesce(F.size(F.from_json("text", f"struct<sources:array<{_SOURCE}>>")["sources"]), F.lit(0)).alias("n"))
    own = violations(head, F.lit(-1), head_rules()).withColumnRenamed("entity_id", "place")
    rest = registry_violations(sources).select(F.lit(0).alias("place"), "rule_no", F.concat("entity_id", F.lit(": "), "message").alias("message"))
    return own.unionAll(rest)


def enabled_sources(sources: DataFrame) -> DataFrame:
    return sources.where(F.coalesce("enabled", F.lit(False)) & F.coalesce("official", F.lit(False)))


def source_counts(sources: DataFrame) -> DataFrame:
    """``sources, enabled, entrypoints``: all sources, the enabled official ones, and the entrypoints of these."""
    on = F.coalesce("enabled", F.lit(False)) & F.coalesce("official", F.lit(False))
    return sources.agg(F.count("*").alias("sources"), F.count_if(on).alias("enabled"), F.coalesce(F.sum(F.when(on, F.size("entrypoints"))), F.lit(0)).alias("entrypoints"))
