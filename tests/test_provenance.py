"""From a fake web to an evaluated review, and what must fail on the way."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

ENTRY, PAGE, OTHER = "https://lab.example.org/news", "https://lab.example.org/news/one", "https://lab.example.org/news/two"
REGISTRY = {
    "schema_version": 1, "default": "deny", "policy": "x", "discovery_defaults": {"scope": "entrypoint_links_only", "same_domain_only": True},
    "sources": [
        {"id": "lab", "organization": "Lab", "official": True, "enabled": True, "domains": ["LAB.example.org"], "entrypoints": [ENTRY], "allowed_url_prefixes": ["https://lab.example.org/news"]},
        {"id": "off", "organization": "Off", "official": True, "enabled": False, "domains": ["off.example.org"], "entrypoints": ["https://off.example.org/"], "allowed_url_prefixes": ["https://off.example.org/"]},
    ],
}
FINDING = "Glass stays solid at room temperature — ñ \"quoted\" \\ and so on."
ARTICLE = f"<html lang='en'><head><title>One</title><script type='application/ld+json'>{{\"@type\":\"NewsArticle\",\"headline\":\"The  one\",\"author\":[{{\"name\":\"Ada\"}},\"Ada\",\"Bob\"]}}</script></head><body><nav>menu</nav><article><h1>Research</h1><h2>Finding</h2><p>{FINDING}</p><ul><li>first</li><li>second</li></ul></article></body></html>"
INDEX = "<a href='/news/one#top'>1</a><a href='two'>x</a><a href='/news/two'>2</a><a href='https://else.example.org/news'>no</a><a href='mailto : a@b.c'>m</a><a href='/news'>self</a>"


def web(pages, calls=None):
    """A getter over a dict of URL to body, or (status, headers, body)."""
    from sparkloom.sources.web import Answer

    def get(url):
        if calls is not None:
            calls.append(url)
        made = pages.get(url, (404, {}, ""))
        status, headers, body = made if isinstance(made, tuple) else (200, {"Content-Type": "text/html; charset=utf-8"}, made)
        return Answer(status, headers, [body.encode()], "utf-8")

    return get


@pytest.fixture(scope="module")
def registry_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("registry") / "registry.json"
    path.write_text(json.dumps(REGISTRY))
    return str(path)


@pytest.fixture(scope="module")
def registry(spark, registry_path):
    from sparkloom.sources.files import read_registry

    return read_registry(spark, registry_path)[0].cache()


PAGES = {ENTRY: INDEX, PAGE: ARTICLE, OTHER: ARTICLE.replace("<nav>menu</nav>", "<nav>other</nav>"), "https://lab.example.org/robots.txt": (200, {"Content-Type": "text/plain"}, "User-agent: *\nDisallow: /private")}


@pytest.fixture(scope="module")
def state(spark, registry, tmp_path_factory):
    """One discovery, two ingestions and a normalization."""
    from sparkloom.operators import acquire
    from sparkloom.operators.store import State

    made = State(spark, str(tmp_path_factory.mktemp("state")))
    runs = acquire.discover(made, registry, web(PAGES), sleep=lambda _: None).collect()
    assert [(r["status"], r["candidate_count"], r["new_count"]) for r in runs] == [("success", 2, 2)]
    urls = acquire.candidate_urls(made, "lab")
    assert [r["url"] for r in urls.collect()] == [PAGE, OTHER]
    acquire.ingest(made, registry, urls, web(PAGES), sleep=lambda _: None)
    acquire.normalize(made, acquire.latest_ingestions(made, "lab"))
    return made


def ledgers(state):
    return state.read("normalization"), state.read("ingestion"), state.read("artifacts")


def cite(spark, state, *refs, url=PAGE):
    from sparkloom.operators.citations import citations

    return citations(spark.createDataFrame([(1, "lab", url, r) for r in refs], "case int, source_id string, requested_url string, block_ref string"), *ledgers(state))


def python_sha(value):
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def blocks_of(state, url=PAGE):
    path = state.read("normalization").where(F.col("requested_url") == url).first()["artifact_path"]
    return json.loads(state.read("artifacts").where(F.col("path") == path).first()["body"])


@pytest.fixture(scope="module")
def bundle(spark, state):
    from sparkloom.operators.citations import build_bundles

    ref = next(b["ref"] for b in blocks_of(state)["blocks"] if b["text"] == FINDING)
    row = build_bundles(cite(spark, state, ref, ref), ["case"]).first()
    assert row["error"] is None
    return row["bundle"]


def test_artifacts_are_canonical_and_addressed(state):
    artifact = blocks_of(state)
    row = state.read("normalization").where(F.col("requested_url") == PAGE).first()
    body = state.read("artifacts").where(F.col("path") == row["artifact_path"]).first()["body"]
    assert python_sha(artifact) == hashlib.sha256(bytes(body)).hexdigest() == row["normalized_sha256"]
    assert artifact["metadata"]["title"] == "The one" and artifact["metadata"]["authors"] == ["Ada", "Bob"] and artifact["metadata"]["language"] == "en"
    assert [(b["kind"], b["heading_path"]) for b in artifact["blocks"]] == [("heading", ["Research"]), ("heading", ["Research", "Finding"]), ("paragraph", ["Research", "Finding"]), ("list", ["Research", "Finding"])]


def test_ingestion_records_changes_and_failures(spark, registry, tmp_path):
    from sparkloom.operators import acquire
    from sparkloom.operators.store import State, StateError

    made = State(spark, str(tmp_path / "s"))
    acquire.discover(made, registry, web(PAGES), sleep=lambda _: None)
    one = spark.createDataFrame([("lab", PAGE)], "source_id string, url string")
    seen = []
    for page in (ARTICLE, ARTICLE, (500, {}, ""), ARTICLE.replace("menu", "other menu"), ARTICLE):
        row = acquire.ingest(made, registry, one, web(PAGES | {PAGE: page}), sleep=lambda _: None).first()
        seen.append(row["classification"] or row["error"])
        if row["status"] == "success":
            new = acquire.normalize(made, acquire.latest_ingestions(made, "lab")).first()
            seen.append(new["classification"])
    assert seen == ["NEW", "NEW", "UNCHANGED", "UNCHANGED", f"unexpected HTTP status 500 for {PAGE}", "CHANGED", "UNCHANGED", "CHANGED", "UNCHANGED"]
    assert made.read("objects").count() == 2 and made.read("artifacts").count() == 1
    with pytest.raises(StateError):
        acquire.ingest(made, registry, spark.createDataFrame([("lab", "https://lab.example.org/news/never")], "source_id string, url string"), web(PAGES), sleep=lambda _: None)
    again = acquire.discover(made, registry, web(PAGES), sleep=lambda _: None).first()
    assert (again["new_count"], again["known_count"]) == (0, 2)
    failed = acquire.discover(made, registry, web({}), sleep=lambda _: None).first()
    assert failed["status"] == "error" and failed["candidate_count"] == 0 and acquire.run_violations(made).count() == 0
    assert {r["seen_count"] for r in acquire.candidate_documents(made).collect()} == {2}
    with pytest.raises(StateError):
        acquire.finish_run(made, failed["run_id"])


def test_stores_never_overwrite(spark, state):
    from sparkloom.operators.store import StateError, store_conflicts, store_exact

    held = state.read("objects")
    path = held.first()["path"]
    other = spark.createDataFrame([(path, bytearray(b"other"))], "path string, body binary")
    assert store_conflicts(held, other).count() == 1 and store_conflicts(held, held).count() == 0
    n = held.count()
    with pytest.raises(StateError):
        store_exact(state, "objects", other)
    store_exact(state, "objects", held)
    assert state.read("objects").count() == n


def test_states_of_other_versions_are_refused(spark, tmp_path):
    from sparkloom.operators.store import TABLES, State, StateError

    with pytest.raises(StateError):
        State(spark, str(tmp_path / "none"), must_exist=True)
    spark.createDataFrame([("discovery", 2)], TABLES["meta"]).write.parquet(str(tmp_path / "s" / "meta"))
    with pytest.raises(StateError):
        State(spark, str(tmp_path / "s"))
    with pytest.raises(StateError):
        State(spark, str(tmp_path / "empty")).require("ingestion")


def test_tampered_objects_and_artifacts_fail(spark, state):
    from sparkloom.operators import citations, store

    normal, ingested, artifacts = ledgers(state)
    good = store.verified_objects(ingested, state.read("objects"))
    assert good.where("error is not null").count() == 0
    wrong = {
        "object is missing": state.read("objects").limit(0),
        "SHA-256 mismatch": state.read("objects").withColumn("body", F.concat("body", F.lit(b"x"))),
    }
    for message, objects in wrong.items():
        assert {r["error"] for r in store.verified_objects(ingested, objects).collect()} == {message}
    for column, value, message in (("bytes_read", F.lit(1), "byte count mismatch"), ("object_path", F.lit("a/../../b"), "path escapes the state folder"), ("sha256", F.lit("x"), "recorded hash is not a SHA-256")):
        assert {r["error"] for r in store.verified_objects(ingested.withColumn(column, value), state.read("objects")).collect()} == {message}
    assert store.verified_artifacts(normal, artifacts).where("error is not null").count() == 0
    for column, value, message in (("block_count", F.lit(1), "block count mismatch"), ("extractor_version", F.lit("0"), "extractor does not match the ledger")):
        assert {r["error"] for r in store.verified_artifacts(normal.withColumn(column, value), artifacts).collect()} == {message}
    bad = normal.where(F.col("requested_url") == PAGE).withColumns({"id": F.col("id") + 100, "normalized_sha256": F.lit("0" * 64)})
    cited = citations.citations(spark.createDataFrame([("lab", PAGE, "b0001")], "source_id string, requested_url string, block_ref string"), normal.unionByName(bad), ingested, artifacts)
    assert cited.first()["error"] == "SHA-256 mismatch"  # the older good one doesn't take its place
    index = citations.document_index(normal.unionByName(bad), ingested, artifacts)
    assert {r["requested_url"]: r["verified"] for r in index.collect()} == {PAGE: False, OTHER: True}


def test_citations_name_one_block(spark, state):
    got = {r["block_ref"]: r for r in cite(spark, state, "b0003-nothing", blocks_of(state)["blocks"][2]["ref"]).collect()}
    assert got["b0003-nothing"]["error"] == "unknown block ref" and got["b0003-nothing"]["item"] is None
    good = next(r for r in got.values() if r["error"] is None)["item"]
    identity = {"source_id": "lab", "requested_url": PAGE, "normalization_observation_id": good["provenance"]["normalization_observation_id"], "normalized_sha256": good["provenance"]["normalized_sha256"], "block_ref": good["block"]["ref"]}
    assert good["evidence_id"] == "ev-" + python_sha(identity)[:20]
    assert cite(spark, state, "x", url="https://lab.example.org/none").first()["error"] == "no successful normalized evidence"


def test_bundles_are_the_same_in_any_order_and_never_cut(spark, state, bundle):
    from sparkloom.operators.citations import build_bundles

    refs = [b["ref"] for b in blocks_of(state)["blocks"]]
    made = [build_bundles(cite(spark, state, *r), ["case"]).first()["bundle"] for r in (refs, [*refs[::-1], refs[0]])]
    assert made[0] == made[1]
    core = {k: v for k, v in json.loads(made[0]).items() if k not in ("bundle_sha256", "bundle_id")}
    assert json.loads(made[0])["bundle_sha256"] == python_sha(core) and core["item_count"] == 4
    assert build_bundles(cite(spark, state, *refs), ["case"], max_items=3).first()["error"] == "too many items"
    assert build_bundles(cite(spark, state, *refs), ["case"], max_chars=5).first()["error"] == "too many characters"
    assert build_bundles(cite(spark, state, refs[0], "none"), ["case"]).first()["error"] == "unknown block ref"
    with pytest.raises(ValueError):
        build_bundles(cite(spark, state, *refs), ["case"], max_items=33)


def rebuilt(bundle, **changes):
    b = json.loads(bundle) | changes
    sha = python_sha({k: v for k, v in b.items() if k not in ("bundle_sha256", "bundle_id")})
    return json.dumps(b | {"bundle_sha256": sha, "bundle_id": f"eb-{sha[:20]}"})


def test_bundles_are_verified_against_their_pinned_observation(spark, state, bundle):
    from sparkloom.operators.citations import verify_bundles

    b = json.loads(bundle)
    forged = json.loads(json.dumps(b["items"]))
    forged[0]["block"]["text"] = "x" * len(FINDING)
    unpinned = json.loads(json.dumps(b["items"]))
    unpinned[0]["provenance"]["normalization_observation_id"] = True
    cases = {
        bundle: None,
        json.dumps(b, indent=3): None,
        "no json": "bundle does not have exactly its fields",
        json.dumps(b | {"more": 1}): "bundle does not have exactly its fields",
        json.dumps({k: v for k, v in b.items() if k != "trust"}): "bundle does not have exactly its fields",
        json.dumps(b | {"items": [b["items"][0] | {"more": None}]}): "bundle does not have exactly its fields",
        json.dumps(b | {"items": unpinned}): "bundle does not have exactly its fields",
        json.dumps(b | {"schema_version": 2}): "unsupported bundle schema version",
        rebuilt(bundle, trust="instructions"): "bundle trust must be external_data_only",
        rebuilt(bundle, items=[], item_count=0, total_chars=0): "bundle requires items",
        rebuilt(bundle, items=b["items"] * 2, item_count=2, total_chars=2 * len(FINDING)): "duplicate evidence id",
        rebuilt(bundle, total_chars=1): "total_chars does not match the text",
        json.dumps(b | {"bundle_sha256": "0" * 64}): "bundle SHA-256 does not match its content",
        json.dumps(b | {"bundle_id": "eb-0"}): "bundle_id does not match its SHA-256",
        rebuilt(bundle, items=forged): "bundled evidence no longer matches the pinned evidence",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "n int, bundle string")
    got = {r["bundle"]: r["error"] for r in verify_bundles(df, *ledgers(state), key=["n"]).collect()}
    assert got == cases
    normal, ingested, artifacts = ledgers(state)
    assert verify_bundles(df.where("n = 0"), normal.limit(0), ingested, artifacts, key=["n"]).first()["error"] == "pinned observation is missing or not successful"
    assert verify_bundles(df.where("n = 0").withColumn("n", F.lit(None).cast("int")), normal.limit(0), ingested, artifacts, key=["n"]).first()["error"]
    later = normal.unionByName(normal.withColumns({"id": F.col("id") + 50, "normalized_sha256": F.lit("1" * 64)}))
    assert verify_bundles(df.where("n = 0"), later, ingested, artifacts, key=["n"]).first()["error"] is None


def case(spark, state, bundle, **columns):
    from sparkloom.operators.citations import verify_bundles

    df = spark.createDataFrame([(1, bundle, *columns.values())], "case int, bundle string, " + ", ".join(f"{c} string" for c in columns))
    return verify_bundles(df, *ledgers(state), key=["case"])


@pytest.fixture(scope="module")
def request_text(spark, state, bundle):
    from sparkloom.operators.claims import build_requests

    return build_requests(case(spark, state, bundle, x="")).first()["request"]


def test_requests_are_rebuilt_to_the_letter(spark, state, bundle, request_text):
    from sparkloom.operators.claims import build_requests, request_error

    r = json.loads(request_text)
    sha = python_sha({k: v for k, v in r.items() if k not in ("request_sha256", "request_id")})
    assert r["request_sha256"] == sha and r["request_id"] == f"er-{sha[:20]}" and set(r["external_data"]["evidence"][0]) == {"evidence_id", "type", "trust", "source_id", "title", "requested_url", "block_ref", "kind", "heading_path", "text"}
    texts = {request_text: None, json.dumps(r | {"more": 1}): "request does not match its bundle and policy", json.dumps(r | {"policy": {}}): "request does not match its bundle and policy", "[]": "request must be a JSON object", json.dumps(r | {"type": "x"}): "request type must be claim_extraction_request"}
    texts[json.dumps(r | {"output_contract": r["output_contract"] | {"max_claims": 99}})] = "max_claims is out of range"
    df = spark.createDataFrame([(t, bundle) for t in texts], "request string, bundle string")
    got = {x["request"]: x["e"] for x in df.select("request", request_error(F.col("request"), F.col("bundle")).alias("e")).collect()}
    assert got == texts
    with pytest.raises(ValueError):
        build_requests(case(spark, state, bundle, x=""), max_claims=33)
    assert build_requests(case(spark, state, "{}", x="")).first()["request"] is None


def test_responses_are_gated_and_compiled(spark, state, bundle, request_text):
    from sparkloom.operators.claims import compile_responses

    eid, rid = json.loads(bundle)["items"][0]["evidence_id"], json.loads(request_text)["request_id"]
    say = lambda claims, **more: json.dumps({"schema_version": 1, "type": "claim_proposal_batch", "request_id": rid, "claims": claims} | more)
    one = {"claim_text": f"  {FINDING}\n", "citations": [eid]}
    cases = {
        say([]): None,
        say([one, {"claim_text": "Another.", "citations": [eid]}]): None,
        "{": "provider output is not a JSON object",
        say([one], more=1): "provider response does not have exactly its fields",
        say([one | {"status": "REVIEWED"}]): "provider response does not have exactly its fields",
        say([one], request_id="er-0"): "provider response request_id does not match the request",
        say([one] * 9): "too many claims",
        say([one | {"claim_text": " \t"}]): "a claim proposal has empty claim_text",
        say([one | {"claim_text": "x" * 1201}]): "a claim proposal is too long",
        say([one | {"citations": []}]): "a claim proposal requires a citation",
        say([one | {"citations": [eid, eid]}]): "a claim proposal repeats a citation",
        say([one | {"citations": ["ev-0"]}]): "a claim proposal cites unknown evidence",
        say([one, one | {"claim_text": FINDING}]): "duplicate claim proposal",
    }
    verified = case(spark, state, bundle, request=request_text)
    df = spark.createDataFrame([(t,) for t in cases], "response string").crossJoin(verified)
    rows = {r["response"]: r for r in compile_responses(df).collect()}
    assert {t: r["error"] for t, r in rows.items()} == cases
    assert rows[say([])]["status"] == "NO_CLAIMS" and rows["{"]["status"] is None
    claims = [c.asDict() for c in rows[list(cases)[1]]["candidates"]]
    assert [c["claim_text"] for c in claims] == ["Another.", FINDING]
    core = {k: v for k, v in claims[1].items() if k not in ("claim_sha256", "claim_id")}
    assert claims[1]["claim_sha256"] == python_sha(core) and claims[1]["claim_id"] == f"cc-{python_sha(core)[:20]}"


def test_claims_are_made_and_validated(spark, state, bundle):
    from sparkloom.operators.claims import claim_error, make_claims

    eid = json.loads(bundle)["items"][0]["evidence_id"]
    verified = case(spark, state, bundle, claim_text=f" {FINDING} ")
    claim = make_claims(verified.withColumn("citations", F.array(F.lit(eid)))).first()["claim"]
    c = json.loads(claim)
    assert make_claims(verified.withColumn("citations", F.array(F.lit(eid), F.lit(eid)))).first()["error"] == "claim has duplicate citations"
    assert make_claims(verified.withColumn("citations", F.array(F.lit("ev-1")))).first()["error"] == "claim cites unknown evidence"
    texts = {claim: None, json.dumps(c | {"status": "APPROVED"}): "claim must remain UNREVIEWED", json.dumps(c | {"claim_text": "x"}): "claim SHA-256 does not match its content", json.dumps(c | {"extra": 1}): "claim does not have exactly its fields", json.dumps(c | {"bundle_id": "eb-1"}): "bundle_id does not match"}
    df = spark.createDataFrame([(t, bundle) for t in texts], "claim string, bundle string")
    got = {x["claim"]: x["e"] for x in df.select("claim", claim_error(F.col("claim"), F.col("bundle")).alias("e")).collect()}
    assert got == texts


def test_providers_run_behind_the_gate(spark, state, bundle, request_text):
    from sparkloom.operators.claims import build_requests, compile_responses, run_provider

    def good(text):
        r = json.loads(text)
        return json.dumps({"schema_version": 1, "type": "claim_proposal_batch", "request_id": r["request_id"], "claims": [{"claim_text": "Yes.", "citations": [r["external_data"]["evidence"][0]["evidence_id"]]}]})

    def bad(text):
        raise KeyError("secret " + text[:9])

    asked = build_requests(case(spark, state, bundle, x="")).drop("x")
    assert compile_responses(run_provider(asked, good)).first()["status"] == "UNREVIEWED_CANDIDATES"
    assert compile_responses(run_provider(asked, bad)).first()["error"] == "provider execution failed (KeyError)"
    assert compile_responses(run_provider(asked.withColumn("error", F.lit("no")), good)).first()["error"] == "no"


def test_reviews_are_complete_or_nothing(spark, state, bundle, request_text):
    from sparkloom.operators.claims import compile_responses
    from sparkloom.operators.review import evaluate_cases

    b, r = json.loads(bundle), json.loads(request_text)
    eid = b["items"][0]["evidence_id"]
    response = json.dumps({"schema_version": 1, "type": "claim_proposal_batch", "request_id": r["request_id"], "claims": [{"claim_text": t, "citations": [eid]} for t in ("A.", "B.")]})
    compiled = compile_responses(case(spark, state, bundle, request=request_text, response=response))
    ids = [c["claim_id"] for c in compiled.first()["candidates"]]
    finding = lambda n: {"finding_id": n, "required_evidence_ids": [eid], "rationale": "why"}
    judge = lambda c, v, *f: {"claim_id": c, "verdict": v, "finding_ids": list(f), "rationale": "so"}
    base = {"schema_version": 1, "type": "human_claim_review", "bundle_id": b["bundle_id"], "bundle_sha256": b["bundle_sha256"], "request_id": r["request_id"], "request_sha256": r["request_sha256"], "reviewer": "R", "expected_findings": [finding("f1"), finding("f2")], "judgments": [judge(ids[0], "supported", "f1"), judge(ids[1], "unassessable")]}
    cases = {
        json.dumps(base): None,
        json.dumps(base | {"more": 1}): "review does not have exactly its fields",
        json.dumps(base | {"request_id": "er-1"}): "review request_id does not match",
        json.dumps(base | {"reviewer": " "}): "reviewer must be a short text",
        json.dumps(base | {"expected_findings": [finding("f1"), finding("f1")]}): "duplicate finding_id",
        json.dumps(base | {"judgments": base["judgments"][:1]}): "every compiled claim needs exactly one human judgment",
        json.dumps(base | {"judgments": base["judgments"][:1] * 2}): "unknown or duplicate reviewed claim_id",
        json.dumps(base | {"judgments": [judge(ids[0], "maybe"), judge(ids[1], "supported")]}): "invalid human verdict",
        json.dumps(base | {"judgments": [judge(ids[0], "unsupported", "f1"), judge(ids[1], "supported")]}): "only fully supported claims may cover expected findings",
        json.dumps(base | {"judgments": [judge(ids[0], "supported", "f9"), judge(ids[1], "supported")]}): "finding_ids must be known and distinct",
    }
    df = spark.createDataFrame([(t,) for t in cases], "review string").crossJoin(compiled)
    rows = {x["review"]: x for x in evaluate_cases(df).collect()}
    assert {t: x["error"] for t, x in rows.items()} == cases
    good = rows[json.dumps(base)]
    assert (good["n_supported"], good["n_unassessable"], good["assessable_claims"], good["abstention"]) == (1, 1, 1, "NOT_APPLICABLE")
    assert tuple(good["supported_claim_precision"]) == (1, 1, 1.0) and tuple(good["finding_coverage"]) == (1, 2, 0.5)
    assert all(rows[t]["n_supported"] is None for t, e in cases.items() if e)
    none = compile_responses(case(spark, state, bundle, request=request_text, response=json.dumps({"schema_version": 1, "type": "claim_proposal_batch", "request_id": r["request_id"], "claims": []})))
    for findings, value, abstention in (([], None, "APPROPRIATE"), ([finding("f1")], 0.0, "INAPPROPRIATE")):
        row = evaluate_cases(none.withColumn("review", F.lit(json.dumps(base | {"expected_findings": findings, "judgments": []})))).first()
        assert row["error"] is None and row["finding_coverage"]["value"] == value and row["abstention"] == abstention and row["supported_claim_precision"]["value"] is None


def test_registries_report_all_that_is_wrong(spark, tmp_path, registry):
    from sparkloom.operators.registry import RegistryError, registry_errors, source_counts
    from sparkloom.sources.files import read_registry

    assert tuple(source_counts(registry).first()) == (2, 1, 1)
    lab = REGISTRY["sources"][0]
    bad = REGISTRY | {"schema_version": 2, "default": "allow", "discovery_defaults": {}, "sources": [lab, lab, lab | {"id": " ", "official": False, "domains": [], "entrypoints": ["http://lab.example.org/"], "allowed_url_prefixes": []}]}
    found = [(r["place"], r["rule_no"]) for r in registry_errors(spark, json.dumps(bad)).collect()]
    assert sorted(found) == [(-1, 1), (-1, 2), (-1, 3), (-1, 4), (0, 1), (0, 2), (0, 3), (0, 4), (0, 6), (0, 7)]
    path = tmp_path / "r.json"
    for text in ("{", json.dumps(bad), "[]"):
        path.write_text(text)
        with pytest.raises(RegistryError):
            read_registry(spark, str(path))


def test_status_and_checks(spark, state, registry, registry_path, tmp_path):
    from sparkloom.operators import assurance

    row = assurance.status(state, registry).first()
    assert (row["source_id"], row["status"], row["ingestion_status"], row["normalization_status"]) == ("lab", "SUCCESS", "SUCCESS", "SUCCESS")
    from sparkloom.operators.store import State

    empty = assurance.status(State(spark, str(tmp_path / "new")), registry).collect()
    assert [(r["status"], r["ingestion_status"], r["candidate_count"]) for r in empty] == [("NEVER_RUN", "NEVER_RUN", 0)]
    assert assurance.all_pass(assurance.doctor(spark, registry_path, str(tmp_path / "new2")))
    wrong = assurance.doctor(spark, str(tmp_path / "none.json"), str(tmp_path / "new3"), {"name": "x", "version": "2"})
    assert not assurance.all_pass(wrong) and {r["name"]: r["status"] for r in wrong.collect()} == {"registry": "FAIL", "state": "PASS", "normalizer": "FAIL"}
    live = lambda pages: [(r["status"], r["candidate_count"]) for r in assurance.verify_live(registry, web(pages), sleep=lambda _: None).collect()]
    blocked = PAGES | {"https://lab.example.org/robots.txt": (200, {}, "User-agent: *\nDisallow: /")}
    assert live(PAGES) == [("PASS", 2)] and live(blocked) == [("BLOCKED", 0)] and live({}) == [("FAIL", 0)]
    found = spark.createDataFrame([("PASS",), ("BLOCKED",)], "s string")
    assert found.agg(assurance.worst(F.col("s")).alias("w")).first()["w"] == "BLOCKED"


def test_the_command_line(spark, state, bundle, request_text, registry_path, tmp_path):
    from sparkloom.cli import answer, parser

    def run(*argv, get=web(PAGES)):
        return answer(spark, parser().parse_args(["--registry", registry_path, "--state", state.path, "--delay", "0", *argv]), get)

    (tmp_path / "b.json").write_text(bundle), (tmp_path / "q.json").write_text(request_text)
    eid = json.loads(bundle)["items"][0]["evidence_id"]
    ref = json.loads(bundle)["items"][0]["block"]["ref"]
    assert run("registry")["enabled"] == 1 and run("doctor")["ok"] and run("status")["sources"][0]["status"] == "SUCCESS" and run("verify-live")["status"] == "PASS"
    assert len(run("list")["documents"]) == 2 and run("cite", "lab", PAGE, ref)["citation"]["block"]["text"] == FINDING and not run("cite", "lab", PAGE, "x")["ok"]
    assert run("bundle", "--cite", "lab", PAGE, ref)["bundle"] == json.loads(bundle) and run("verify-bundle", str(tmp_path / "b.json")) == {"ok": True}
    assert run("request", str(tmp_path / "b.json"))["request"] == json.loads(request_text) and run("verify-request", str(tmp_path / "q.json"), str(tmp_path / "b.json"))["ok"]
    assert run("make-claim", str(tmp_path / "b.json"), "Yes.", eid)["claim"]["status"] == "UNREVIEWED"
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(ValueError):
        run("verify-bundle", str(tmp_path / "bad.json"))


def test_texts_for_people(spark, state, bundle):
    from sparkloom.functions import render
    from sparkloom.functions.documents import BUNDLE, parsed
    from sparkloom.operators.citations import document_index

    b = json.loads(bundle)
    item = b["items"][0]
    df = spark.createDataFrame([(bundle,)], "bundle string").select(parsed(F.col("bundle"), BUNDLE).alias("b"))
    whole, cited = df.select(render.bundle_text(F.col("b")), render.citation_text(F.col("b.items")[0])).first()
    assert whole.startswith(f"EVIDENCE BUNDLE — external data only\nBundle: {b['bundle_id']}\n") and f"\n\n[{item['evidence_id']}] The one\n" in whole and whole.endswith(FINDING)
    assert "Heading: Research > Finding\n" in cited and f"\n\n{FINDING}\n\nProvenance:\n" in cited
    row = document_index(*ledgers(state)).select(F.struct("*").alias("d")).select(render.indexed_text(F.col("d"))).first()[0]
    assert row.startswith("[lab] The one\nURL: https://lab.example.org/news/") and "| status: NEW\n" in row
    none = spark.createDataFrame([("NO_CLAIMS",)], "s string").select(render.result_text(F.col("s"), F.array().cast("array<struct<claim_id:string,claim_text:string,citations:array<string>>>"))).first()[0]
    assert none == "Extraction: NO_CLAIMS\nCandidates: 0\nSemantic support: UNASSESSED\nSemantic truth: UNASSESSED"


def test_validations_have_texts(spark):
    from sparkloom.functions import render

    rows = spark.sql("SELECT named_struct('bundle_id', 'eb-1', 'item_count', 2L, 'total_chars', 30L) AS b, named_struct('claim_id', 'cc-1', 'citations', array('ev-1', 'ev-2', 'ev-3')) AS c, e FROM VALUES (CAST(NULL AS STRING)), ('broken') AS t(e)")
    bundles, claims = (rows.orderBy(F.col("e").isNotNull()).select(made.alias("t")).collect() for made in (render.bundle_validation_text(F.col("b"), F.col("e")), render.claim_validation_text(F.col("c"), F.col("e"))))
    assert bundles[0]["t"].splitlines() == ["Bundle eb-1: VALID", "Items: 2 | chars: 30", "Citation integrity: VALID", "Provenance integrity: VALID", "Semantic support: UNASSESSED"]
    assert claims[0]["t"].splitlines() == ["Claim cc-1: citation contract VALID", "Citations: 3", "Citation integrity: VALID", "Provenance integrity: VALID", "Review status: UNREVIEWED", "Semantic support: UNASSESSED", "Semantic truth: UNASSESSED"]
    assert bundles[1]["t"] is None and claims[1]["t"] is None
