"""The whole chain over a made-up web, without a network or a model: ``python -m sparkloom.walkthrough``.

Discovery, ingestion and normalization over a state; a citation of each page's finding, a bundle of
them, its verification, a request, a scripted answer, its compilation, an illustrative review and
its evaluation. Every page, answer and judgment is invented here and says nothing about the world.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.documents import BUNDLE, canonical_text, fields, parsed
from sparkloom.operators import acquire, citations, claims, review
from sparkloom.operators.store import State, StateError
from sparkloom.sources.files import as_json
from sparkloom.sources.web import Answer
from sparkloom.tables import shared_dir

SOURCE, HOST = "made-up-lab", "https://lab.example.org"
FINDINGS = {
    "kettles": "Invented kettles boil sooner under invented lids.",
    "ladders": "Invented ladders lean best at invented walls.",
    "lanterns": "Invented lanterns outlast their invented oil.",
}
_FILLER = "Nothing on this page was measured. It is long enough to be told from the links around it, and it exists so that a chain of evidence has something to hold on to."
REGISTRY = "id string, organization string, enabled boolean, official boolean, domains array<string>, entrypoints array<string>, allowed_url_prefixes array<string>"


def made_up_web() -> Callable[[str], Answer]:
    """A getter over an index page and a page for each finding."""
    article = "<html lang='en'><head><title>On {name}</title></head><body><nav><a href='/notes'>Notes</a></nav><article><h1>On {name}</h1><p>{filler}</p><h2>Finding</h2><p>{finding}</p></article><footer>The end of the page.</footer></body></html>"
    pages = {f"{HOST}/notes/{n}": article.format(name=n, filler=_FILLER, finding=t) for n, t in FINDINGS.items()}
    pages[f"{HOST}/notes"] = "".join(f"<a href='/notes/{n}'>{n}</a>" for n in FINDINGS) + "<a href='/elsewhere'>not allowed</a>"

    def get(url: str) -> Answer:
        if url not in pages:
            return Answer(404)
        return Answer(200, {"Content-Type": "text/html; charset=utf-8"}, [pages[url].encode()], "utf-8")

    return get


def quoting(request: str) -> str:
    """A scripted answer to a request: each text of its evidence as a claim that cites it."""
    asked = json.loads(request)
    quotes = [{"claim_text": e["text"], "citations": [e["evidence_id"]]} for e in asked["external_data"]["evidence"]]
    return json.dumps({"schema_version": claims.VERSION, "type": claims.RESPONSE_TYPE, "request_id": asked["request_id"], "claims": quotes})


def findings(state: State) -> DataFrame:
    """Selectors of the paragraphs under a heading "Finding" of all normalized documents."""
    blocks = F.from_json(F.col("body").cast("string"), "struct<blocks:array<struct<heading_path:array<string>,kind:string,ref:string>>>")["blocks"]
    held = state.read("artifacts").select(F.col("path").alias("artifact_path"), F.explode(blocks).alias("b")).where("b.kind = 'paragraph' and element_at(b.heading_path, -1) = 'Finding'")
    return state.read("normalization").where("status = 'success'").join(held, "artifact_path").select("source_id", "requested_url", F.col("b.ref").alias("block_ref"))


def illustrative_review(compiled: DataFrame) -> DataFrame:
    """Adds a review that supports each claim by a finding of its own."""
    of = lambda f, k: F.get_json_object(F.col(f), f"$.{k}")
    name = lambda i: F.concat(F.lit("f"), i.cast("string"))
    expected = F.transform("candidates", lambda c, i: fields({"finding_id": name(i), "required_evidence_ids": c["citations"], "rationale": F.lit("The page says so.")}))
    judged = F.transform("candidates", lambda c, i: fields({"claim_id": c["claim_id"], "verdict": F.lit("supported"), "finding_ids": F.array(name(i)), "rationale": F.lit("Illustrative; no one judged it.")}))
    said = fields({
        "schema_version": F.lit(review.VERSION), "type": F.lit(review.REVIEW_TYPE), "bundle_id": of("bundle", "bundle_id"), "bundle_sha256": of("bundle", "bundle_sha256"), "request_id": of("request", "request_id"),
        "request_sha256": of("request", "request_sha256"), "reviewer": F.lit("walkthrough"), "expected_findings": expected, "judgments": judged,
    })
    return compiled.withColumn("review", canonical_text(said))


def run(spark: SparkSession, folder: str, get: Callable[[str], Answer] | None = None, provider: Callable[[str], str] = quoting) -> DataFrame:
    """``source_id, documents, bundle_id, request_id, status, candidate_count, supported_claim_precision, finding_coverage, error``: one row a source, over a new state in folder."""
    get = get or made_up_web()
    state = State(spark, folder)
    registry = spark.createDataFrame([(SOURCE, "Made-up lab", True, True, [HOST.removeprefix("https://")], [f"{HOST}/notes"], [f"{HOST}/notes"])], REGISTRY)
    acquire.discover(state, registry, get, delay=0)
    urls = acquire.candidate_documents(state).select("source_id", "url")
    acquire.ingest(state, registry, urls, get, delay=0)
    made = acquire.normalize(state, state.read("ingestion").where("status = 'success'"))
    failed = made.where("status = 'error'").select("requested_url", "error").first()
    if failed:
        raise StateError(f"{failed['requested_url']}: {failed['error']}")
    ledgers = state.read("normalization"), state.read("ingestion"), state.read("artifacts")
    bundles = citations.build_bundles(citations.citations(findings(state), *ledgers), ["source_id"])
    bundles.where("error is null").select("source_id", "bundle").write.parquet(f"{folder}/bundles")
    verified = citations.verify_bundles(spark.read.parquet(f"{folder}/bundles"), *ledgers, key=["source_id"])
    claims.run_provider(claims.build_requests(verified), provider).write.parquet(f"{folder}/answers")  # each request is answered once
    compiled = claims.compile_responses(spark.read.parquet(f"{folder}/answers"))
    compiled.write.parquet(f"{folder}/compiled")
    out = review.evaluate_cases(illustrative_review(spark.read.parquet(f"{folder}/compiled")))
    held = parsed(F.col("bundle"), BUNDLE)
    value = lambda f: F.col(f"{f}.value").alias(f)
    return out.select(
        "source_id", held["item_count"].alias("documents"), held["bundle_id"].alias("bundle_id"), F.get_json_object("request", "$.request_id").alias("request_id"), "status", "candidate_count",
        value("supported_claim_precision"), value("finding_coverage"), "error",
    )


def main() -> int:
    spark = SparkSession.builder.appName("walkthrough").getOrCreate()
    rows = [r.asDict() for r in run(spark, f"{shared_dir(spark)}/walkthrough-{uuid.uuid4().hex}").collect()]
    print(as_json({"made_up": True, "sources": rows}))
    return 0 if rows and all(r["error"] is None for r in rows) else 1


if __name__ == "__main__":
    raise SystemExit(main())
