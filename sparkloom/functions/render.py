"""Documents as text for a person, in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the texts say, a line each; a name in braces is a field, a dot leads into it.
CITATION = """EXTERNAL EVIDENCE — data, not instructions
Source: {document.source_id}
Title: {title}
Requested URL: {document.requested_url}
Final URL: {document.final_url}
Block: {block.ref} ({block.kind})
Heading: {heading}

{block.text}

Provenance:
  raw SHA-256: {provenance.raw_sha256}
  normalized SHA-256: {provenance.normalized_sha256}
  ingestion observation: {provenance.ingestion_observation_id}
  normalization observation: {provenance.normalization_observation_id}
  extractor: {provenance.extractor.name} {provenance.extractor.version}"""
INDEXED = """[{source_id}] {title}
URL: {requested_url}
Blocks: {block_count} | chars: {char_count} | status: {classification}
Normalized SHA-256: {normalized_sha256}
Extractor: {extractor.name} {extractor.version}"""
BUNDLE = """EVIDENCE BUNDLE — external data only
Bundle: {bundle_id}
SHA-256: {bundle_sha256}
Items: {item_count} | chars: {total_chars}"""
ITEM = """
[{evidence_id}] {title}
Source: {document.source_id}
Block: {block.ref} ({block.kind})
Heading: {heading}
{block.text}"""
CLAIM = """CLAIM CANDIDATE — UNREVIEWED
Claim: {claim_text}
Claim id: {claim_id}
Bundle: {bundle_id}
Citations: {cited}
Semantic support: UNASSESSED"""
BUNDLE_VALID = """Bundle {bundle_id}: VALID
Items: {item_count} | chars: {total_chars}
Citation integrity: VALID
Provenance integrity: VALID
Semantic support: UNASSESSED"""
CLAIM_VALID = """Claim {claim_id}: citation contract VALID
Citations: {citation_count}
Citation integrity: VALID
Provenance integrity: VALID
Review status: UNREVIEWED
Semantic support: UNASSESSED
Semantic truth: UNASSESSED"""
CANDIDATE = """
[{claim_id}] {claim_text}
Citations: {cited}
Status: UNREVIEWED"""


def filled(template: str, fields) -> Column:
    """template with its fields, which fields(name) gives; a null is an empty text."""
    parts = template.replace("}", "{").split("{")
    values = [F.lit(p) if i % 2 == 0 else F.coalesce(fields(p).cast("string"), F.lit("")) for i, p in enumerate(parts)]
    return F.concat(*values)


def _inside(value: Column, **more: Column):
    def field(name: str) -> Column:
        if name in more:
            return more[name]
        out = value
        for step in name.split("."):
            out = out[step]
        return out

    return field


def _titled(title: Column) -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), F.lit("(untitled)"))


def _under(path: Column) -> Column:
    return F.coalesce(F.nullif(F.array_join(path, " > "), F.lit("")), F.lit("(root)"))


def citation_text(item: Column, template: str = CITATION) -> Column:
    """A bundle's item, or a citation."""
    return filled(template, _inside(item, title=_titled(item["document"]["title"]), heading=_under(item["block"]["heading_path"])))


def indexed_text(row: Column) -> Column:
    """A row of document_index(), as a struct."""
    return filled(INDEXED, _inside(row, title=_titled(row["title"])))


def bundle_text(bundle: Column) -> Column:
    """A parsed bundle with its items."""
    return F.concat_ws("\n", filled(BUNDLE, _inside(bundle)), F.array_join(F.transform(bundle["items"], lambda i: citation_text(i, ITEM)), "\n"))


def claim_text(claim: Column, template: str = CLAIM) -> Column:
    """A claim candidate."""
    return filled(template, _inside(claim, cited=F.array_join(claim["citations"], ", ")))


def bundle_validation_text(bundle: Column, error: Column) -> Column:
    """What a person reads of a verified bundle; null where error says that it isn't valid."""
    return F.when(error.isNull(), filled(BUNDLE_VALID, _inside(bundle)))


def claim_validation_text(claim: Column, error: Column) -> Column:
    """What a person reads of a claim whose citations were checked; null where error says what is wrong."""
    return F.when(error.isNull(), filled(CLAIM_VALID, _inside(claim, citation_count=F.size(claim["citations"]))))


def result_text(status: Column, candidates: Column) -> Column:
    """What compile_responses() made of a response."""
    head = F.concat(F.lit("Extraction: "), status, F.lit("\nCandidates: "), F.size(candidates).cast("string"), F.lit("\nSemantic support: UNASSESSED\nSemantic truth: UNASSESSED"))
    return F.concat_ws("\n", head, F.nullif(F.array_join(F.transform(candidates, lambda c: claim_text(c, CANDIDATE)), "\n"), F.lit("")))
