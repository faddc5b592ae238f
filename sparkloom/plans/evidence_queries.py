"""Provenance queries over ledgers made of the conversations: a document for each turn, a bundle for each conversation."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.arrays import let
from sparkloom.functions.documents import BUNDLE, canonical_text, fields, parsed
from sparkloom.functions.provenance import object_path
from sparkloom.functions.text import normalize_markdown
from sparkloom.operators import citations, claims, review, store
from sparkloom.operators.blocks import blocks_of
from sparkloom.operators.long_blocks import blocks_of_lines
from sparkloom.tables import saved

_KEYS = ["conv_id", "turn"]


def turns(spark: SparkSession, d: str) -> DataFrame:
    """Each turn as a Markdown document of two headings and a paragraph."""
    flat = F.trim(F.regexp_replace("text", r"\s+", " "))
    md = F.concat(F.lit("# conv "), F.col("conv_id").cast("string"), F.lit("\r\n\r\n\r\n## "), "role", F.lit("  \n\nT: "), flat, F.lit("\n"))
    return spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", md.alias("md"))


#: The blocks of those documents: t, b and k (with ref).
BLOCKS_SQL = r"""t AS (SELECT conv_id, turn, role, 'T: ' || trim(regexp_replace(text, '\s+', ' ', 'g')) AS body FROM conversations),
b AS (SELECT conv_id, turn, 1 AS ordinal, 'heading' AS kind, 'conv ' || conv_id AS path, '# conv ' || conv_id AS text FROM t
UNION ALL SELECT conv_id, turn, 2, 'heading', 'conv ' || conv_id || ' > ' || role, '## ' || role FROM t
UNION ALL SELECT conv_id, turn, 3, 'paragraph', 'conv ' || conv_id || ' > ' || role, trim(body) FROM t),
k AS (SELECT *, 'b' || lpad(ordinal::varchar, 4, '0') || '-' || sha256(text)[1:12] AS ref FROM b)"""


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    """The artifacts' texts of all turns, written once: what reads them plans over a table, not over how they were made."""
    extractor = fields({"name": F.lit("q"), "version": F.lit("1")})
    rows = turns(spark, d).select(*_KEYS, blocks_of(normalize_markdown(F.col("md"))).alias("blocks"))
    body = canonical_text(fields({"blocks": F.col("blocks"), "extractor": extractor, "schema_version": F.lit(1).cast("long")}))
    return saved(rows.select(*_KEYS, F.get("blocks", F.lit(2))["ref"].alias("third"), F.size("blocks").cast("long").alias("block_count"), body.alias("body")), "bodies")[0]


def _ledgers(spark: SparkSession, d: str, bodies: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Normalizations, ingestions and artifacts of all turns."""
    rows = bodies or _bodies(spark, d)
    name = F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    raw = F.sha2(F.concat(F.lit("raw "), name), 256)
    id_ = (F.col("conv_id") * 1000 + F.col("turn") + 1).cast("long")
    both = [*_KEYS, id_.alias("id"), F.concat(F.lit("s"), (F.col("conv_id") % 5).cast("string")).alias("source_id"), F.concat(F.lit("https://c.example/"), name).alias("requested_url"), F.lit("success").alias("status")]
    sha = F.sha2("body", 256)
    normal = rows.select(
        *both, id_.alias("ingestion_observation_id"), raw.alias("raw_sha256"), F.lit("q").alias("extractor_name"), F.lit("1").alias("extractor_version"), F.lit("n").alias("normalized_at"), F.lit("NEW").alias("classification"),
        sha.alias("normalized_sha256"), object_path(sha, "normalized", ".json").alias("artifact_path"), F.lit(None).cast("string").alias("title"), "block_count", F.length("body").cast("long").alias("char_count"),
    )
    ingested = turns(spark, d).select(*both, F.concat(F.lit("https://c.example/"), name).alias("final_url"), F.lit("f").alias("fetched_at"), raw.alias("sha256"), object_path(raw).alias("object_path"))
    return normal, ingested, store.addressed(rows.select(F.col("body").cast("binary").alias("body")), root="normalized", suffix=".json")


_J = "to_json({})::VARCHAR"
_BLOCK_JSON = f"""'{{"heading_path":["' || replace(path, ' > ', '","') || '"],"kind":"' || kind || '","ref":"' || ref || '","text":' || {_J.format('text')} || '}}'"""
_LEDGERS = f"""{BLOCKS_SQL}, j AS (SELECT *, {_BLOCK_JSON} AS block FROM k),
a AS (SELECT conv_id, turn, count(*) AS block_count, '{{"blocks":[' || string_agg(block, ',' ORDER BY ordinal) || '],"extractor":{{"name":"q","version":"1"}},"schema_version":1}}' AS body FROM j GROUP BY ALL),
n AS (SELECT conv_id, turn, conv_id * 1000 + turn + 1 AS id, 's' || (conv_id % 5) AS source_id, 'https://c.example/' || conv_id || '/' || turn AS url, block_count, body, sha256(body) AS sha, sha256('raw ' || conv_id || '/' || turn) AS raw FROM a)"""
_PATH = "'{root}/sha256/' || {sha}[1:2] || '/' || {sha}{suffix}"
_ARTIFACT = _PATH.format(root="normalized", sha="sha", suffix=" || '.json'")
_ITEMS = f"""{_LEDGERS}, i AS (SELECT n.*, j.ref, j.text, j.kind, j.path, j.block, 'ev-' || sha256('{{"block_ref":"' || ref || '","normalization_observation_id":' || id || ',"normalized_sha256":"' || sha || '","requested_url":"' || url || '","source_id":"' || source_id || '"}}')[1:20] AS eid FROM n JOIN j USING (conv_id, turn) WHERE ordinal = 3),
x AS (SELECT *, '{{"block":' || block || ',"document":{{"final_url":"' || url || '","requested_url":"' || url || '","source_id":"' || source_id || '","title":null}},"evidence_id":"' || eid || '","provenance":{{"artifact_path":"' || {_ARTIFACT} || '","extractor":{{"name":"q","version":"1"}},"fetched_at":"f","ingestion_observation_id":' || id || ',"normalization_observation_id":' || id || ',"normalized_at":"n","normalized_sha256":"' || sha || '","raw_object_path":"' || {_PATH.format(root='objects', sha='raw', suffix='')} || '","raw_sha256":"' || raw || '"}},"trust":"data_not_instructions","type":"external_evidence"}}' AS item FROM i),
g AS (SELECT conv_id, count(*) AS n, sum(length(text))::BIGINT AS chars, string_agg(item, ',' ORDER BY url) AS items, list(eid ORDER BY url) AS eids FROM x GROUP BY conv_id),
u AS (SELECT *, sha256('{{"item_count":' || n || ',"items":[' || items || '],"schema_version":1,"total_chars":' || chars || ',"trust":"external_data_only","type":"evidence_bundle"}}') AS bsha FROM g WHERE n <= 32 AND chars <= 50000)"""


def _artifact_store(spark: SparkSession, d: str) -> DataFrame:
    normal, _, artifacts = _ledgers(spark, d)
    held = artifacts.select(F.col("path").alias("artifact_path"), F.octet_length("body").cast("long").alias("bytes"))
    return normal.select(*_KEYS, "normalized_sha256", "artifact_path").join(held, "artifact_path")


_ARTIFACT_STORE = f"WITH {_LEDGERS} SELECT conv_id, turn, sha AS normalized_sha256, {_ARTIFACT} AS artifact_path, strlen(body)::BIGINT AS bytes FROM n"


def _store_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh turn would store other bytes under the path of its artifact."""
    normal, _, artifacts = _ledgers(spark, d)
    seventh = normal.where("turn % 7 = 0").select(F.col("artifact_path").alias("path"))
    return store.store_conflicts(artifacts, artifacts.join(seventh.distinct(), "path", "left_semi").withColumn("body", F.concat("body", F.lit(b" "))))


_STORE_CONFLICTS = f"WITH {_LEDGERS} SELECT DISTINCT {_ARTIFACT} AS path FROM n WHERE turn % 7 = 0"


def _verified_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Ledger rows that differ from what is stored in several ways."""
    normal, _, artifacts = _ledgers(spark, d)
    c, t = F.col("conv_id"), F.col("turn")
    changed = normal.withColumns({
        "artifact_path": F.when(c % 11 == 0, "normalized/none").when(c % 13 == 0, F.concat(F.lit("../"), "artifact_path")).otherwise(F.col("artifact_path")),
        "normalized_sha256": F.when(t % 7 == 3, F.col("raw_sha256")).otherwise(F.col("normalized_sha256")),
        "extractor_version": F.when(t % 5 == 4, "2").otherwise("1"), "block_count": F.when(t % 3 == 2, 4).otherwise(F.col("block_count")),
    })
    return store.verified_artifacts(changed, artifacts).select(*_KEYS, "error")


_VERIFIED_ARTIFACTS = f"""WITH {_LEDGERS} SELECT conv_id, turn, CASE WHEN conv_id % 11 = 0 THEN 'object is missing' WHEN conv_id % 13 = 0 THEN 'path escapes the state folder' WHEN turn % 7 = 3 THEN 'SHA-256 mismatch'
 WHEN turn % 5 = 4 THEN 'extractor does not match the ledger' WHEN turn % 3 = 2 THEN 'block count mismatch' END AS error FROM n"""


def _selectors(bodies: DataFrame) -> DataFrame:
    """The paragraph of each turn."""
    rows = bodies.select(*_KEYS, F.col("third").alias("block_ref"))
    name = F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    return rows.select(*_KEYS, F.concat(F.lit("s"), (F.col("conv_id") % 5).cast("string")).alias("source_id"), F.concat(F.lit("https://c.example/"), name).alias("requested_url"), "block_ref")


def _citation_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth turn asks for a block that isn't there, every seventh for a document that isn't."""
    t = F.col("turn")
    bodies = _bodies(spark, d)
    asked = _selectors(bodies).withColumns({"block_ref": F.when(t % 5 == 0, "b0009-0").otherwise(F.col("block_ref")), "requested_url": F.when(t % 7 == 6, "https://none.example/").otherwise(F.col("requested_url"))})
    return citations.citations(asked, *_ledgers(spark, d, bodies)).select(*_KEYS, F.col("item.evidence_id").alias("evidence_id"), F.col("item.block.text").alias("text"), "error")


_CITATION_LOOKUP = f"""WITH {_ITEMS} SELECT conv_id, turn, CASE WHEN turn % 5 <> 0 AND turn % 7 <> 6 THEN eid END AS evidence_id, CASE WHEN turn % 5 <> 0 AND turn % 7 <> 6 THEN text END AS text,
 CASE WHEN turn % 7 = 6 THEN 'no successful normalized evidence' WHEN turn % 5 = 0 THEN 'unknown block ref' END AS error FROM x"""


def _bundles(spark: SparkSession, d: str, bodies: DataFrame) -> DataFrame:
    """Bundles of citations, which are written once: a bundle's limits and its items each read them."""
    cited, _ = saved(citations.citations(_selectors(bodies), *_ledgers(spark, d, bodies)), "cited")
    return citations.build_bundles(cited, ["conv_id"], 32, 50_000)


def _bundle_totals(spark: SparkSession, d: str) -> DataFrame:
    b = parsed(F.col("bundle"), BUNDLE)
    return _bundles(spark, d, _bodies(spark, d)).select("conv_id", b["item_count"].alias("item_count"), b["total_chars"].alias("total_chars"), b["bundle_sha256"].alias("bundle_sha256"), b["bundle_id"].alias("bundle_id"), "error")


_BUNDLE_TOTALS = f"""WITH {_ITEMS} SELECT g.conv_id, u.n AS item_count, u.chars AS total_chars, bsha AS bundle_sha256, 'eb-' || bsha[1:20] AS bundle_id,
 CASE WHEN g.n > 32 THEN 'too many items' WHEN g.chars > 50000 THEN 'too many characters' END AS error FROM g LEFT JOIN u USING (conv_id)"""


def _verified(spark: SparkSession, d: str, tampered: Column | None = None) -> DataFrame:
    bodies = _bodies(spark, d)
    rows, _ = saved(_bundles(spark, d, bodies).where("bundle is not null").select("conv_id", "bundle"), "bundles")
    rows = rows if tampered is None else rows.withColumn("bundle", tampered)
    return citations.verify_bundles(rows, *_ledgers(spark, d, bodies), key=["conv_id"])


def _bundle_verify(spark: SparkSession, d: str) -> DataFrame:
    c, text = F.col("conv_id"), F.col("bundle")
    forged = lambda b: canonical_text(citations.bundle_of(F.transform(b["items"], lambda i: i.withField("document", i["document"].withField("title", F.lit("forged"))))))
    changed = F.when(c % 5 == 1, F.replace(text, F.lit('"schema_version":1,'), F.lit('"schema_version":2,'))).when(c % 5 == 2, F.concat(F.lit('{"more":1,'), F.substr(text, F.lit(2))))
    changed = changed.when(c % 5 == 3, let(parsed(text, BUNDLE), forged)).when(c % 5 == 4, F.left(text, F.lit(9))).otherwise(text)
    return _verified(spark, d, changed).select("conv_id", "error")


_BUNDLE_VERIFY = f"""WITH {_ITEMS} SELECT conv_id, CASE conv_id % 5 WHEN 1 THEN 'unsupported bundle schema version' WHEN 2 THEN 'bundle does not have exactly its fields' WHEN 3 THEN 'bundled evidence no longer matches the pinned evidence' WHEN 4 THEN 'bundle does not have exactly its fields' END AS error FROM u"""


def _requests(spark: SparkSession, d: str) -> DataFrame:
    return claims.build_requests(_verified(spark, d))


def _request_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """Requests, every third with another policy, checked against their bundles."""
    rows = _requests(spark, d)
    saved = F.when(F.col("conv_id") % 3 == 1, F.replace("request", F.lit('"version":1'), F.lit('"version":9'))).otherwise(F.col("request"))
    rows = rows.withColumn("saved", saved)
    return rows.select("conv_id", F.get_json_object("request", "$.request_id").alias("request_id"), F.get_json_object("request", "$.request_sha256").alias("request_sha256"), claims.request_error(F.col("saved"), F.col("bundle")).alias("error"))


def _constant(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).replace("'", "''")


_POLICY = _constant({"version": 1, "role": "claim_extraction", "evidence_trust": "external_data_only", "rules": claims.RULES})
_CONTRACT = _constant({"schema_version": 1, "type": "claim_proposal_batch", "empty_claims_allowed": True, "max_claims": 8, "max_claim_chars": 1200, "claim_fields": ["claim_text", "citations"], "forbidden_authority": claims.FORBIDDEN})
_VIEW = f"""'{{"block_ref":"' || ref || '","evidence_id":"' || eid || '","heading_path":["' || replace(path, ' > ', '","') || '"],"kind":"' || kind || '","requested_url":"' || url || '","source_id":"' || source_id || '","text":' || {_J.format('text')} || ',"title":null,"trust":"data_not_instructions","type":"external_evidence"}}'"""
_ASKED = f"""{_ITEMS}, v AS (SELECT conv_id, string_agg({_VIEW}, ',' ORDER BY url) AS views FROM x GROUP BY conv_id),
q AS (SELECT u.*, 'eb-' || bsha[1:20] AS bid, sha256('{{"external_data":{{"bundle_id":"eb-' || bsha[1:20] || '","bundle_sha256":"' || bsha || '","evidence":[' || views || '],"item_count":' || n || ',"total_chars":' || chars || ',"trust":"external_data_only","type":"evidence_bundle_view"}},"output_contract":{_CONTRACT},"policy":{_POLICY},"schema_version":1,"type":"claim_extraction_request"}}') AS qsha FROM u JOIN v USING (conv_id))"""
_REQUEST_REBUILD = f"WITH {_ASKED} SELECT conv_id, 'er-' || qsha[1:20] AS request_id, qsha AS request_sha256, CASE WHEN conv_id % 3 = 1 THEN 'request does not match its bundle and policy' END AS error FROM q"


def _compiled(spark: SparkSession, d: str) -> DataFrame:
    """Responses of up to three claims; some conversations answer none, cite what they don't have, or claim authority."""
    rows = _requests(spark, d)
    c = F.col("conv_id")
    proposal = lambda i: fields({"claim_text": F.concat(F.lit("  Claim of "), i["evidence_id"], F.lit("\n")), "citations": F.array(F.when(c % 7 == 3, F.lit("ev-0")).otherwise(i["evidence_id"]))})
    proposals = F.transform(F.slice(parsed(F.col("bundle"), BUNDLE)["items"], 1, 3), proposal)
    proposals = F.when(c % 7 == 2, F.slice(proposals, 1, 0)).otherwise(proposals)
    said = canonical_text(fields({"schema_version": F.lit(1), "type": F.lit(claims.RESPONSE_TYPE), "request_id": F.get_json_object("request", "$.request_id"), "claims": proposals}))
    said = F.when(c % 7 == 4, F.replace(said, F.lit('"claim_text"'), F.lit('"status":"REVIEWED","claim_text"'))).otherwise(said)
    return claims.compile_responses(rows.withColumn("response", said))


def _response_compile(spark: SparkSession, d: str) -> DataFrame:
    return _compiled(spark, d).select("conv_id", "status", F.array_join(F.transform("candidates", lambda x: x["claim_id"]), ",").alias("claim_ids"), "error")


_CLAIMED = f"""{_ASKED}, p AS (SELECT *, list_sort(list_transform(eids[1:3], lambda e: 'Claim of ' || e)) AS texts FROM q),
y AS (SELECT conv_id, qsha, bid, bsha, eids, conv_id % 7 AS m, list_transform(CASE WHEN conv_id % 7 = 2 THEN texts[1:0] ELSE texts END, lambda s: 'cc-' || sha256('{{"bundle_id":"' || bid || '","bundle_sha256":"' || bsha || '","citations":["' || s[10:] || '"],"claim_text":"' || s || '","schema_version":1,"semantic_support":"UNASSESSED","status":"UNREVIEWED","type":"claim_candidate"}}')[1:20]) AS ids FROM p),
z AS (SELECT *, CASE m WHEN 3 THEN 'a claim proposal cites unknown evidence' WHEN 4 THEN 'provider response does not have exactly its fields' END AS error FROM y)"""
_RESPONSE_COMPILE = f"WITH {_CLAIMED} SELECT conv_id, CASE WHEN error IS NULL THEN CASE WHEN len(ids) > 0 THEN 'UNREVIEWED_CANDIDATES' ELSE 'NO_CLAIMS' END END AS status, CASE WHEN error IS NULL THEN array_to_string(ids, ',') END AS claim_ids, error FROM z"


def _review_coverage(spark: SparkSession, d: str) -> DataFrame:
    """The first claim is supported and covers a finding, the others aren't; every fifth review leaves a claim out."""
    rows = _compiled(spark, d)
    c, ids = F.col("conv_id"), F.transform("candidates", lambda x: x["claim_id"])
    judged = F.when(c % 5 == 0, F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0)))).otherwise(ids)
    none = F.array().cast("array<string>")
    judgment = lambda x, i: fields({"claim_id": x, "verdict": F.when(i == 0, "supported").when(i == 1, "unsupported").otherwise("unassessable"), "finding_ids": F.when((i == 0) & (c % 2 == 1), F.array(F.lit("f1"))).otherwise(none), "rationale": F.lit("so")})
    first = lambda x, n: fields({"finding_id": F.lit(n), "rationale": F.lit("why"), "required_evidence_ids": x})
    cited = F.coalesce(F.get("candidates", F.lit(0))["citations"], F.slice(F.transform(parsed(F.col("bundle"), BUNDLE)["items"], lambda i: i["evidence_id"]), 1, 1))
    findings = F.when(c % 2 == 1, F.array(first(cited, "f1"), first(cited, "f2"))).otherwise(F.slice(F.array(first(cited, "f1")), 1, 0))
    of = lambda f, k: F.get_json_object(F.col(f), f"$.{k}")
    text = canonical_text(fields({
        "schema_version": F.lit(1), "type": F.lit(review.REVIEW_TYPE), "bundle_id": of("bundle", "bundle_id"), "bundle_sha256": of("bundle", "bundle_sha256"), "request_id": of("request", "request_id"), "request_sha256": of("request", "request_sha256"),
        "reviewer": F.lit("R"), "expected_findings": findings, "judgments": F.transform(judged, judgment),
    }))
    out = review.evaluate_cases(rows.withColumn("review", text))
    value = lambda f: F.col(f"{f}.value").alias(f)
    return out.select("conv_id", "candidate_count", "assessable_claims", value("supported_claim_precision"), value("unsupported_claim_rate"), value("finding_coverage"), "abstention", "error")


_REVIEW_COVERAGE = f"""WITH {_CLAIMED}, e AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'structural validation failed: ' || error WHEN conv_id % 5 = 0 AND len(ids) > 0 THEN 'every compiled claim needs exactly one human judgment' END AS problem FROM z)
SELECT conv_id, CASE WHEN problem IS NULL THEN len(ids) END AS candidate_count, CASE WHEN problem IS NULL THEN least(len(ids), 2) END AS assessable_claims,
 CASE WHEN problem IS NULL AND len(ids) > 0 THEN 1.0 / least(len(ids), 2) END AS supported_claim_precision, CASE WHEN problem IS NULL AND len(ids) > 0 THEN (CASE WHEN len(ids) > 1 THEN 0.5 ELSE 0.0 END)::DOUBLE END AS unsupported_claim_rate,
 CASE WHEN problem IS NULL AND conv_id % 2 = 1 THEN (CASE WHEN len(ids) > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE END AS finding_coverage,
 CASE WHEN problem IS NULL THEN CASE WHEN len(ids) > 0 THEN 'NOT_APPLICABLE' WHEN conv_id % 2 = 1 THEN 'INAPPROPRIATE' ELSE 'APPROPRIATE' END END AS abstention, problem AS error FROM e"""


def _conversation_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Each conversation as one document, a row for each line: two headings a turn, its text, every third in a fence with what is no heading there."""
    body = F.trim(F.concat(F.lit("T: "), F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))))
    heads = [F.concat(F.lit("# Turn "), F.col("turn").cast("string")), F.lit(""), F.concat(F.lit("## "), F.coalesce("role", F.lit("none"))), F.lit("")]
    fenced = [F.lit("```"), body, F.lit(""), F.lit("# no heading"), F.lit("```")]
    lines = F.when(F.col("turn") % 3 == 1, F.array(*heads, *fenced, F.lit(""))).otherwise(F.array(*heads, body, F.lit("")))
    rows = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", F.posexplode(lines).alias("i", "line"))
    made = blocks_of_lines(rows.select("conv_id", (F.col("turn") * 10 + F.col("i")).alias("n"), "line"), ["conv_id"], "n", "line")
    return made.select("conv_id", "ordinal", "ref", "kind", F.array_join("heading_path", " > ").alias("path"), "text")


_CONVERSATION_BLOCKS = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, 'none') AS role, trim('T: ' || trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS body, 3 * (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) AS before FROM conversations),
b AS (SELECT conv_id, before + 1 AS ordinal, 'heading' AS kind, 'Turn ' || turn AS path, '# Turn ' || turn AS text FROM t
UNION ALL SELECT conv_id, before + 2, 'heading', 'Turn ' || turn || ' > ' || role, '## ' || role FROM t
UNION ALL SELECT conv_id, before + 3, CASE WHEN turn % 3 = 1 THEN 'code' ELSE 'paragraph' END, 'Turn ' || turn || ' > ' || role, CASE WHEN turn % 3 = 1 THEN '```' || chr(10) || body || chr(10) || chr(10) || '# no heading' || chr(10) || '```' ELSE body END FROM t)
SELECT conv_id, ordinal::INT AS ordinal, 'b' || lpad(ordinal::varchar, greatest(4, length(ordinal::varchar))::INT, '0') || '-' || sha256(text)[1:12] AS ref, kind, path, text FROM b"""


def queries() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]]:
    """Each query with its SQL."""
    return {
        "conversation_blocks": (_conversation_blocks, _CONVERSATION_BLOCKS),
        "artifact_store": (_artifact_store, _ARTIFACT_STORE), "store_conflicts": (_store_conflicts, _STORE_CONFLICTS), "verified_artifacts": (_verified_artifacts, _VERIFIED_ARTIFACTS),
        "citation_lookup": (_citation_lookup, _CITATION_LOOKUP), "bundle_totals": (_bundle_totals, _BUNDLE_TOTALS), "bundle_verify": (_bundle_verify, _BUNDLE_VERIFY),
        "request_rebuild": (_request_rebuild, _REQUEST_REBUILD), "response_compile": (_response_compile, _RESPONSE_COMPILE), "review_coverage": (_review_coverage, _REVIEW_COVERAGE),
    }
