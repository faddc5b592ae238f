"""JSON documents with fixed shapes: canonical text, exact shape, first broken rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.arrays import let
from sparkloom.functions.text import SPACE

#: Control characters that have no short escape; Jackson writes their codes in upper case, canonical text in lower case.
_ESCAPES = [f"{c:02X}" for c in (0x0B, 0x0E, 0x0F, *range(0x1A, 0x20))]

# The shapes, with fields in alphabetical order, so that to_json() writes them canonically.
BLOCK = "struct<heading_path:array<string>,kind:string,ref:string,text:string>"
DOCUMENT = "struct<final_url:string,requested_url:string,source_id:string,title:string>"
EXTRACTOR = "struct<name:string,version:string>"
PROVENANCE = f"struct<artifact_path:string,extractor:{EXTRACTOR},fetched_at:string,ingestion_observation_id:bigint,normalization_observation_id:bigint,normalized_at:string,normalized_sha256:string,raw_object_path:string,raw_sha256:string>"
ITEM = f"struct<block:{BLOCK},document:{DOCUMENT},evidence_id:string,provenance:{PROVENANCE},trust:string,type:string>"
BUNDLE = f"struct<bundle_id:string,bundle_sha256:string,item_count:bigint,items:array<{ITEM}>,schema_version:bigint,total_chars:bigint,trust:string,type:string>"
CLAIM = "struct<bundle_id:string,bundle_sha256:string,citations:array<string>,claim_id:string,claim_sha256:string,claim_text:string,schema_version:bigint,semantic_support:string,status:string,type:string>"
RESPONSE = "struct<claims:array<struct<citations:array<string>,claim_text:string>>,request_id:string,schema_version:bigint,type:string>"
FINDING = "struct<finding_id:string,rationale:string,required_evidence_ids:array<string>>"
JUDGMENT = "struct<claim_id:string,finding_ids:array<string>,rationale:string,verdict:string>"
REVIEW = f"struct<bundle_id:string,bundle_sha256:string,expected_findings:array<{FINDING}>,judgments:array<{JUDGMENT}>,request_id:string,request_sha256:string,reviewer:string,schema_version:bigint,type:string>"
ARTIFACT_HEAD = f"struct<blocks:array<{BLOCK}>,extractor:{EXTRACTOR},schema_version:bigint>"


def _lower_escapes(json: Column) -> Column:
    out = json
    for code in _ESCAPES:
        out = F.regexp_replace(out, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}")
    return F.when(json.rlike(r"\\u00(0[BEF]|1[A-F])"), out).otherwise(json)


def canonical_text(value: Column) -> Column:
    """A struct with fields in alphabetical order as JSON: sorted keys, nulls kept, no spaces."""
    return let(F.to_json(value, {"ignoreNullFields": "false"}), _lower_escapes)


def canonical_json_text(text: Column) -> Column:
    """Any JSON text with sorted keys and no spaces; null if it isn't JSON."""
    return let(F.to_json(F.try_parse_json(text)), _lower_escapes)


def parsed(text: Column, shape: str) -> Column:
    """The document as a struct; null if it isn't a JSON object."""
    return F.when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT<"), F.from_json(text, shape))


def has_shape(text: Column, document: Column) -> Column:
    """Whether a text has exactly the keys and types of the document parsed from it, at all levels: writing what was read gives it back."""
    return F.coalesce(canonical_text(document) == canonical_json_text(text), F.lit(False))


def sha_of(value: Column) -> Column:
    return F.sha2(canonical_text(value), 256)


def fields(values: dict[str, Column]) -> Column:
    """A struct with fields in alphabetical order."""
    return F.struct(*[values[k].alias(k) for k in sorted(values)])


def identified(core: dict[str, Column], sha: str, id_: str, prefix: str) -> Column:
    """A document with its hash and an id made of the hash."""
    own = lambda c, h: fields({k: c[k] for k in core} | {sha: h, id_: F.concat(F.lit(prefix), F.left(h, F.lit(20)))})
    return let(fields(core), lambda c: let(sha_of(c), lambda h: own(c, h)))


def stripped(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def distinct(values: Column) -> Column:
    return F.size(F.array_distinct(values)) == F.size(values)


def first_broken(rules: list[tuple[str, Column]]) -> Column:
    """The message of the first rule that doesn't hold, or null; an unknown outcome breaks a rule."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(message)) for message, ok in rules])
