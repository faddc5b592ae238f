"""Command line: one JSON answer (or, if asked, text) on standard output, exit code 0 or 1."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.documents import BUNDLE, canonical_text, parsed
from sparkloom.functions.render import bundle_text, citation_text
from sparkloom.operators import acquire, assurance, citations, claims, review
from sparkloom.operators.registry import RegistryError, source_counts
from sparkloom.operators.store import State, StateError
from sparkloom.sources.files import DOCUMENT_BYTES, as_json, read_document, read_registry


def http_get(url: str):
    """A getter over the network, without redirects of its own."""
    import requests

    from sparkloom.sources.web import AGENT, Answer

    r = requests.get(url, headers={"User-Agent": AGENT}, timeout=(5, 15), stream=True, allow_redirects=False)
    return Answer(r.status_code, dict(r.headers), r.iter_content(1 << 16), r.encoding, r.close)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkloom", description=__doc__)
    p.add_argument("--registry", default="sources/registry.json")
    p.add_argument("--state", default="state")
    p.add_argument("--delay", type=float, default=1.0)
    p.add_argument("--text", action="store_true", help="citations and bundles as text for a person")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("registry", "doctor", "status"):
        sub.add_parser(name)
    for name in ("discover", "verify-live"):
        sub.add_parser(name).add_argument("--source")
    for name in ("ingest", "normalize"):
        c = sub.add_parser(name)
        c.add_argument("source")
        c.add_argument("--limit", type=int, default=1)
    c = sub.add_parser("list")
    c.add_argument("--source"), c.add_argument("--url"), c.add_argument("--limit", type=int, default=20)
    c = sub.add_parser("cite")
    c.add_argument("source"), c.add_argument("url"), c.add_argument("ref")
    c = sub.add_parser("bundle")
    c.add_argument("--cite", nargs=3, action="append", required=True, metavar=("SOURCE", "URL", "REF"))
    c.add_argument("--max-items", type=int, default=8), c.add_argument("--max-chars", type=int, default=12_000)
    sub.add_parser("verify-bundle").add_argument("bundle")
    c = sub.add_parser("make-claim")
    c.add_argument("bundle"), c.add_argument("text"), c.add_argument("citations", nargs="+")
    c = sub.add_parser("validate-claim")
    c.add_argument("claim"), c.add_argument("bundle")
    c = sub.add_parser("request")
    c.add_argument("bundle"), c.add_argument("--max-claims", type=int, default=8), c.add_argument("--max-claim-chars", type=int, default=1200)
    for name, files in (("verify-request", ["request", "bundle"]), ("validate-response", ["response", "request", "bundle"]), ("evaluate", ["bundle", "request", "response", "review"])):
        c = sub.add_parser(name)
        for f in files:
            c.add_argument(f)
    return p


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def _case(spark: SparkSession, state: State, a) -> DataFrame:
    """One row of the documents that a command names, its bundle verified."""
    made = {}
    for name in ("bundle", "request", "response", "review", "claim"):
        if hasattr(a, name):
            row = read_document(spark, getattr(a, name), "struct<type:string>", DOCUMENT_BYTES).first()
            if row["error"]:
                raise ValueError(f"cannot read valid JSON from {getattr(a, name)}: {row['error']}")
            made[name] = row["text"]
    df = spark.createDataFrame([(1, *made.values())], "case int, " + ", ".join(f"{n} string" for n in made))
    return citations.verify_bundles(df, state.read("normalization"), state.read("ingestion"), state.read("artifacts"), key=["case"])


def answer(spark: SparkSession, a, get=http_get) -> dict:
    """What a command has to say; ok tells the exit code."""
    registry = lambda: read_registry(spark, a.registry)[0]
    if a.command == "registry":
        return {"ok": True} | _rows(source_counts(registry()))[0]
    if a.command == "doctor":
        checks = assurance.doctor(spark, a.registry, a.state)
        return {"ok": assurance.all_pass(checks), "checks": _rows(checks)}
    if a.command == "verify-live":
        found = assurance.verify_live(registry(), get, a.source, delay=a.delay)
        rows = _rows(found)
        worst = spark.createDataFrame(rows, "source_id string, status string, candidate_count long, detail string").agg(assurance.worst(F.col("status")).alias("s")).first()["s"]
        return {"ok": worst == "PASS", "status": worst, "sources": rows}
    state = State(spark, a.state, must_exist=a.command not in ("discover", "status"))
    if a.command == "status":
        return {"ok": True, "sources": _rows(assurance.status(state, registry()))}
    if a.command == "discover":
        rows = _rows(acquire.discover(state, registry(), get, a.source, delay=a.delay))
        return {"ok": all(r["status"] == "success" for r in rows), "runs": rows}
    if a.command in ("ingest", "normalize"):
        if a.command == "ingest":
            made = acquire.ingest(state, registry(), acquire.candidate_urls(state, a.source, a.limit), get, delay=a.delay)
        else:
            made = acquire.normalize(state, acquire.latest_ingestions(state, a.source, a.limit))
        summary = _rows(acquire.stage_summary(made))
        return {"ok": bool(summary) and all(r["ok"] for r in summary), "summary": summary, "results": _rows(made)}
    state.require("ingestion", "normalization")
    ledgers = state.read("normalization"), state.read("ingestion"), state.read("artifacts")
    if a.command == "list":
        wanted = ledgers[0]
        wanted = wanted if a.source is None else wanted.where(F.col("source_id") == a.source)
        wanted = wanted if a.url is None else wanted.where(F.col("requested_url") == a.url)
        rows = _rows(citations.document_index(wanted, *ledgers[1:], limit=a.limit))
        return {"ok": all(r["verified"] for r in rows), "documents": rows}
    if a.command in ("cite", "bundle"):
        selectors = [(a.source, a.url, a.ref)] if a.command == "cite" else [tuple(c) for c in a.cite]
        cited = citations.citations(spark.createDataFrame([(1, *s) for s in selectors], "case int, source_id string, requested_url string, block_ref string"), *ledgers)
        if a.command == "cite":
            return _told(cited.select(canonical_text(F.col("item")).alias("citation"), citation_text(F.col("item")).alias("as_text"), "error"), "citation", a.text)
        made = citations.build_bundles(cited, ["case"], a.max_items, a.max_chars)
        return _told(made.withColumn("as_text", bundle_text(parsed(F.col("bundle"), BUNDLE))), "bundle", a.text)
    case = _case(spark, state, a)
    if a.command == "verify-bundle":
        return _told(case, None)
    if a.command == "make-claim":
        case = case.withColumns({"claim_text": F.lit(a.text), "citations": F.array(*[F.lit(c) for c in a.citations])})
        return _told(claims.make_claims(case), "claim")
    if a.command == "validate-claim":
        return _told(case.withColumn("error", F.coalesce("error", claims.claim_error(F.col("claim"), F.col("bundle")))), None)
    if a.command == "request":
        return _told(claims.build_requests(case, max_claims=a.max_claims, max_claim_chars=a.max_claim_chars), "request")
    if a.command == "verify-request":
        return _told(case.withColumn("error", F.coalesce("error", claims.request_error(F.col("request"), F.col("bundle")))), None)
    compiled = claims.compile_responses(case)
    if a.command == "validate-response":
        return _told(compiled, "candidates")
    return _told(review.evaluate_cases(compiled).drop("bundle", "request", "response", "review", "candidates", "case", "status"), "*")


def _told(df: DataFrame, field: str | None, text: bool = False) -> dict:
    row = df.first().asDict(recursive=True)
    if row["error"] is not None:
        return {"ok": False, "error": row["error"]}
    if text:
        return {"ok": True, "text": row["as_text"]}
    if field == "*":
        return {"ok": True} | {k: v for k, v in row.items() if k != "error"}
    value = row[field] if field else None
    return {"ok": True} | ({} if field is None else {field: json.loads(value) if isinstance(value, str) else value})


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("sparkloom").getOrCreate()
    try:
        said = answer(spark, a)
    except (StateError, RegistryError, ValueError) as e:
        said = {"ok": False, "error": str(e)}
    print(said["text"] if "text" in said else as_json(said))
    return 0 if said["ok"] else 1


if __name__ == "__main__":
    sys.exit(main())
