"""Human review of compiled claims: a structural gate first, then a complete review, then ratios; never part of a score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.arrays import let
from sparkloom.functions.documents import BUNDLE, REVIEW, distinct, first_broken, has_shape, parsed, stripped
from sparkloom.operators.evidence import VERDICTS, abstention, ratio

#: Version, type and limits of a review.
VERSION, REVIEW_TYPE, ENTRIES, LONG_TEXT, SHORT_TEXT = 1, "human_claim_review", 64, 2000, 100


def _text_ok(c: Column, limit: int = LONG_TEXT) -> Column:
    return (stripped(c) != "") & (F.length(c) <= limit)


def review_error(review: Column, bundle: Column, request: Column, candidates: Column) -> Column:
    """What is wrong with a review, or null: its identity, findings within the evidence, one judgment for each claim, covered findings cited."""
    asked = "struct<request_id:string,request_sha256:string>"
    rules = lambda b, q, r: first_broken(_review_rules(review, r, b, q, candidates))
    return let(parsed(bundle, BUNDLE), lambda b: let(parsed(request, asked), lambda q: let(parsed(review, REVIEW), lambda r: rules(b, q, r))))


def _review_rules(review: Column, r: Column, b: Column, asked: Column, candidates: Column) -> list[tuple[str, Column]]:
    findings, judgments = r["expected_findings"], r["judgments"]
    every = lambda values, ok: F.forall(values, lambda x: F.coalesce(ok(x), F.lit(False)))
    evidence = F.transform(b["items"], lambda i: i["evidence_id"])
    names = F.transform(findings, lambda f: f["finding_id"])
    claims = F.transform(candidates, lambda c: c["claim_id"])
    judged = F.transform(judgments, lambda j: j["claim_id"])
    known = lambda values, all_of: (F.size(F.array_except(values, all_of)) == 0) & distinct(values) & (F.size(values) <= ENTRIES)
    cited = lambda j: F.get(F.filter(candidates, lambda c: c["claim_id"] == j["claim_id"]), F.lit(0))["citations"]
    required = lambda name: F.get(F.filter(findings, lambda f: f["finding_id"] == name), F.lit(0))["required_evidence_ids"]
    return [
        ("review does not have exactly its fields", has_shape(review, r)),
        ("unsupported review schema version", r["schema_version"] == VERSION),
        ("review type must be human_claim_review", r["type"] == REVIEW_TYPE),
        ("review bundle_id does not match", r["bundle_id"] == b["bundle_id"]),
        ("review bundle_sha256 does not match", r["bundle_sha256"] == b["bundle_sha256"]),
        ("review request_id does not match", r["request_id"] == asked["request_id"]),
        ("review request_sha256 does not match", r["request_sha256"] == asked["request_sha256"]),
        ("reviewer must be a short text", _text_ok(r["reviewer"], SHORT_TEXT)),
        ("too many expected_findings", F.size(findings) <= ENTRIES),
        ("finding_id must be a short text", every(findings, lambda f: _text_ok(f["finding_id"], SHORT_TEXT))),
        ("duplicate finding_id", distinct(names)),
        ("required_evidence_ids must be known, distinct and not empty", every(findings, lambda f: (F.size(f["required_evidence_ids"]) > 0) & known(f["required_evidence_ids"], evidence))),
        ("finding rationale must be a text", every(findings, lambda f: _text_ok(f["rationale"]))),
        ("compiled result has duplicate claim IDs", distinct(claims)),
        ("too many judgments", F.size(judgments) <= ENTRIES),
        ("unknown or duplicate reviewed claim_id", (F.size(F.array_except(judged, claims)) == 0) & distinct(judged)),
        ("invalid human verdict", every(judgments, lambda j: j["verdict"].isin(*VERDICTS))),
        ("judgment rationale must be a text", every(judgments, lambda j: _text_ok(j["rationale"]))),
        ("finding_ids must be known and distinct", every(judgments, lambda j: known(j["finding_ids"], names))),
        ("only fully supported claims may cover expected findings", every(judgments, lambda j: (F.size(j["finding_ids"]) == 0) | (j["verdict"] == "supported"))),
        ("matched finding lacks a required cited evidence ID", every(judgments, lambda j: every(j["finding_ids"], lambda name: F.size(F.array_except(required(name), cited(j))) == 0))),
        ("every compiled claim needs exactly one human judgment", F.size(F.array_except(claims, judged)) == 0),
    ]


def evaluate_cases(compiled: DataFrame, bundle: str = "bundle", request: str = "request", review: str = "review") -> DataFrame:
    """Adds the evaluation to rows of compile_responses() with a review; all of it is null where error isn't.

    ``candidate_count``, ``n_`` and each verdict, ``assessable_claims``, and numerator, denominator and value
    (null for a denominator of 0) of supported_claim_precision, unsupported_claim_rate and
    finding_coverage, and abstention.
    """
    gate = F.when(F.col("error").isNotNull(), F.concat(F.lit("structural validation failed: "), "error"))
    out = compiled.withColumn("error", F.coalesce(gate, review_error(F.col(review), F.col(bundle), F.col(request), F.col("candidates"))))
    out = out.withColumn("_r", F.when(F.col("error").isNull(), parsed(F.col(review), REVIEW)))
    r, judgments = F.col("_r"), F.col("_r.judgments")
    n = lambda v: F.size(F.filter(judgments, lambda j: j["verdict"] == v)).cast("long")
    assessable = n("supported") + n("partially_supported") + n("unsupported")
    covered = F.size(F.array_distinct(F.flatten(F.transform(judgments, lambda j: j["finding_ids"])))).cast("long")
    expected = F.size(r["expected_findings"]).cast("long")
    made = {
        "candidate_count": F.size("candidates").cast("long"), **{f"n_{v}": n(v) for v in VERDICTS}, "assessable_claims": assessable,
        "supported_claim_precision": ratio(n("supported"), assessable), "unsupported_claim_rate": ratio(n("unsupported"), assessable),
        "finding_coverage": ratio(covered, expected), "abstention": abstention(F.size("candidates"), expected),
    }
    return out.withColumns({k: F.when(F.col("error").isNull(), v) for k, v in made.items()}).drop("_r")
