"""Evidence: fail-closed provenance joins, citations, bundles, claims and their review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.provenance import canonical_json, derived_id, sha256
from sparkloom.operators.ledger import latest

#: Default and hard limits of bundles and claims.
MAX_ITEMS, HARD_ITEMS, MAX_CHARS, HARD_CHARS = 8, 32, 12_000, 50_000
MAX_CLAIMS, HARD_CLAIMS, CLAIM_CHARS, HARD_CLAIM_CHARS = 8, 32, 1_200, 4_000
VERDICTS = ("supported", "partially_supported", "unsupported", "unassessable")
DOCUMENT_KEYS = ["source_id", "requested_url"]


def documents(normalizations: DataFrame, ingestions: DataFrame, limit: int | None = None) -> DataFrame:
    """The latest successful normalization of each document with its ingestion, newest first.

    Latest is chosen before any check, so that a bad row is never hidden behind an older good one.
    """
    last = latest(normalizations.where("status = 'success'"), DOCUMENT_KEYS).alias("n")
    joined = last.join(ingestions.alias("i"), F.col("n.ingestion_observation_id") == F.col("i.id"))
    good = joined.where("i.status = 'success'").orderBy(F.desc("n.normalized_at"), "n.source_id", "n.requested_url")
    return good if limit is None else good.limit(limit)


def provenance_rules() -> list[tuple[str, Column]]:
    """Rules over n joined with i: same source, URL and raw bytes, and somewhere to find them."""
    return [
        ("source differs", F.col("n.source_id") == F.col("i.source_id")),
        ("URL differs", F.col("n.requested_url") == F.col("i.requested_url")),
        ("raw hash differs", F.col("n.raw_sha256") == F.col("i.sha256")),
        ("no final URL or object path", F.col("i.final_url").isNotNull() & F.col("i.object_path").isNotNull()),
    ]


def proposal_rules(known: Column) -> list[tuple[str, Column]]:
    """Rules over claim_text and citations of a proposal; known: the bundle's evidence ids."""
    text, cites = F.col("claim_text"), F.col("citations")
    return [
        ("empty claim", F.trim(text) != ""),
        ("claim too long", F.length(text) <= CLAIM_CHARS),
        ("no citations", F.size(cites) > 0),
        ("repeated citation", F.size(F.array_distinct(cites)) == F.size(cites)),
        ("unknown citation", F.size(F.array_except(cites, known)) == 0),
    ]


def ratio(numerator: Column, denominator: Column) -> Column:
    """Numerator, denominator and value, which is null for a denominator of 0."""
    return F.struct(numerator.alias("numerator"), denominator.alias("denominator"), (numerator / F.nullif(denominator, F.lit(0))).alias("value"))


def review_metrics(judgments: DataFrame, by: list[str]) -> DataFrame:
    """Verdict counts of many judgments, and ratios over those that could be assessed; null for none."""
    n = lambda v: F.count_if(F.col("verdict") == v)
    out = judgments.groupBy(*by).agg(*[n(v).alias(f"n_{v}") for v in VERDICTS], F.count("verdict").alias("n_claims"))
    out = out.withColumn("assessable_claims", F.col("n_supported") + F.col("n_partially_supported") + F.col("n_unsupported"))
    share = lambda v: ratio(F.col(f"n_{v}"), F.col("assessable_claims"))["value"]
    return out.withColumns({"supported_precision": share("supported"), "unsupported_rate": share("unsupported")})


def abstention(claims: Column, findings: Column) -> Column:
    """Whether a case without claims rightly has none: it is appropriate if there was nothing to find."""
    return F.when(claims > 0, "NOT_APPLICABLE").when(findings == 0, "APPROPRIATE").otherwise("INAPPROPRIATE")
