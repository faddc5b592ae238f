"""Allow-lists of very many sources: URLs meet prefixes by equality, never one URL with all prefixes.

A registry is a table (``id, enabled, official, domains, allowed_url_prefixes``). Its prefixes are first
made minimal, so that a URL starts with at most one of its source's. A URL is then cut at the lengths
that occur among its source's prefixes, and a cut that is a prefix is found by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.urls import host_of, is_https
from sparkloom.tables import unused

#: Prefixes that are broadcast after a count; more are joined by an exchange.
BROADCAST_PREFIXES = 200_000
#: Parts over which the URLs under one prefix are spread where prefixes are exchanged.
SALTS = 32


def _cuts(text: Column, lengths: Column) -> Column:
    """The heads of text at the given lengths, itself included."""
    return F.transform(F.filter(lengths, lambda n: n <= F.char_length(text)), lambda n: F.substring(text, F.lit(1), n))


def minimal_prefixes(prefixes: DataFrame) -> DataFrame:
    """``source_id, prefix``: without repeats, nulls and those that start with another of their source.

    What any of the prefixes allows, the minimal ones allow.
    """
    rows = prefixes.select("source_id", "prefix").where("source_id is not null and prefix is not null").distinct()
    shorter = F.filter(F.col("lengths"), lambda n: n < F.char_length("prefix"))
    heads = rows.join(prefix_lengths(rows), "source_id").select("source_id", "prefix", F.explode(_cuts(F.col("prefix"), shorter)).alias("head"))
    longer = heads.join(rows.select("source_id", F.col("prefix").alias("head")), ["source_id", "head"], "left_semi").select("source_id", "prefix")
    return rows.join(longer, ["source_id", "prefix"], "left_anti")


def prefix_lengths(prefixes: DataFrame) -> DataFrame:
    """``source_id, lengths``: the lengths that occur among a source's prefixes; few, whatever their number."""
    return prefixes.groupBy("source_id").agg(F.collect_set(F.char_length("prefix")).alias("lengths"))


def allowed_urls(urls: DataFrame, registry: DataFrame) -> DataFrame:
    """The rows of urls (``source_id, url`` and any others) that are candidates of an enabled official source.

    The same answer as is_allowed_candidate() for each row: https, a listed host, a listed prefix.
    Repeated rows stay repeated; a null source or URL is not allowed; an empty prefix allows every URL
    on a listed host; a registry without rows allows nothing. Rows of a registry that share an id are
    one source with all their hosts and prefixes. urls is read once, and moves only where the
    prefixes are too many to broadcast.
    """
    active = registry.where(F.coalesce(F.col("enabled") & F.col("official"), F.lit(False))).withColumnRenamed("id", "source_id")
    hosts = active.select("source_id", F.explode("domains").alias("host")).select("source_id", F.lower("host").alias("host")).distinct()
    listed = minimal_prefixes(active.select("source_id", F.explode("allowed_url_prefixes").alias("prefix")))

    host, lengths, prefix, salt = unused(urls, "host", "lengths", "prefix", "salt")
    rows = urls.where(is_https(F.col("url"))).withColumn(host, host_of(F.col("url")))
    rows = rows.join(hosts.withColumnRenamed("host", host), ["source_id", host], "left_semi")
    rows = rows.join(prefix_lengths(listed).withColumnRenamed("lengths", lengths), "source_id")
    heads = rows.withColumn(prefix, F.explode(_cuts(F.col("url"), F.col(lengths)))).drop(lengths, host)
    known = listed.withColumnRenamed("prefix", prefix)
    if listed.limit(BROADCAST_PREFIXES + 1).count() <= BROADCAST_PREFIXES:
        found = heads.join(F.broadcast(known), ["source_id", prefix], "left_semi")
    else:
        known = known.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = heads.withColumn(salt, F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int")).join(known, ["source_id", prefix, salt], "left_semi")
    return found.select(*urls.columns)
