"""Citations, immutable evidence bundles and their verification, as columns of small documents.

A bundle is one JSON text in a row; it has at most HARD_ITEMS items, so it is checked where it
stands, and only its items meet the ledgers, in one join for all bundles.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.arrays import let
from sparkloom.functions.documents import BUNDLE, canonical_text, distinct, first_broken, has_shape, identified, parsed, sha_of
from sparkloom.functions.provenance import HEX64
from sparkloom.operators.evidence import DOCUMENT_KEYS, HARD_CHARS, HARD_ITEMS, MAX_CHARS, MAX_ITEMS, provenance_rules
from sparkloom.operators.ledger import latest
from sparkloom.operators.store import verified_artifacts
from sparkloom.tables import saved

#: What evidence and bundles call themselves.
EVIDENCE_TYPE, EVIDENCE_TRUST, BUNDLE_TYPE, BUNDLE_TRUST, BUNDLE_VERSION = "external_evidence", "data_not_instructions", "evidence_bundle", "external_data_only", 1


def evidence_id(document: Column, block: Column, provenance: Column) -> Column:
    """The id of a block of one observation: it depends on what is cited, not on how it is described."""
    identity = F.struct(
        block["ref"].alias("block_ref"), provenance["normalization_observation_id"].alias("normalization_observation_id"),
        provenance["normalized_sha256"].alias("normalized_sha256"), document["requested_url"].alias("requested_url"), document["source_id"].alias("source_id"),
    )
    return F.concat(F.lit("ev-"), F.left(sha_of(identity), F.lit(20)))


def identity_rules(document: Column, block: Column, provenance: Column) -> list[tuple[str, Column]]:
    """What an evidence identity needs."""
    return [
        ("citation source_id is required", document["source_id"] != ""),
        ("citation requested_url is required", document["requested_url"] != ""),
        ("citation block ref is required", block["ref"] != ""),
        ("normalization_observation_id must be positive", provenance["normalization_observation_id"] >= 1),
        ("normalized_sha256 is not a SHA-256", provenance["normalized_sha256"].rlike(HEX64)),
    ]


_NORMAL = "id source_id requested_url ingestion_observation_id raw_sha256 extractor_name extractor_version normalized_at status classification normalized_sha256 artifact_path title block_count char_count".split()
_INGESTED = "id source_id requested_url final_url fetched_at sha256 object_path".split()


def linked(normalizations: DataFrame, ingestions: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Normalizations ``n`` with their ingestions ``i``, blocks, and the first reason not to trust them; other columns are left out."""
    rows = verified_artifacts(normalizations.select(*_NORMAL), artifacts).withColumnRenamed("error", "artifact_error")
    joined = rows.alias("n").join(ingestions.where("status = 'success'").select(*_INGESTED).alias("i"), F.col("n.ingestion_observation_id") == F.col("i.id"))
    return joined.withColumn("link_error", F.coalesce(first_broken(provenance_rules()), F.col("n.artifact_error")))


def _item(block: Column) -> Column:
    """A bundle's item of a linked row and one of its blocks."""
    document = F.struct(F.col("i.final_url").alias("final_url"), F.col("n.requested_url").alias("requested_url"), F.col("n.source_id").alias("source_id"), F.col("n.title").alias("title"))
    extractor = F.struct(F.col("n.extractor_name").alias("name"), F.col("n.extractor_version").alias("version"))
    provenance = F.struct(
        F.col("n.artifact_path").alias("artifact_path"), extractor.alias("extractor"), F.col("i.fetched_at").alias("fetched_at"), F.col("n.ingestion_observation_id").alias("ingestion_observation_id"),
        F.col("n.id").alias("normalization_observation_id"), F.col("n.normalized_at").alias("normalized_at"), F.col("n.normalized_sha256").alias("normalized_sha256"),
        F.col("i.object_path").alias("raw_object_path"), F.col("n.raw_sha256").alias("raw_sha256"),
    )
    return F.struct(
        block.alias("block"), document.alias("document"), evidence_id(document, block, provenance).alias("evidence_id"),
        provenance.alias("provenance"), F.lit(EVIDENCE_TRUST).alias("trust"), F.lit(EVIDENCE_TYPE).alias("type"),
    )


def _cited(rows: DataFrame, missing: str) -> DataFrame:
    """Adds item and error to rows that have block_ref and the columns of linked(), or nulls if nothing is linked."""
    own = F.filter("blocks", lambda b: b["ref"] == F.col("block_ref"))
    block = F.get(own, F.lit(0))
    rules = [
        ("unknown block ref", F.size(own) > 0),
        ("duplicate block ref", F.size(own) == 1),
        ("citation block has no text", block["text"] != ""),
        ("citation block has no kind", block["kind"] != ""),
        ("citation block has invalid heading_path", F.forall(block["heading_path"], lambda h: h.isNotNull())),
    ]
    error = F.when(F.col("n.id").isNull(), F.lit(missing)).otherwise(F.coalesce("link_error", first_broken(rules)))
    return rows.withColumn("error", error).withColumn("item", F.when(F.col("error").isNull(), _item(block)))


def citations(selectors: DataFrame, normalizations: DataFrame, ingestions: DataFrame, artifacts: DataFrame) -> DataFrame:
    """selectors (``source_id, requested_url, block_ref`` and more) with ``item`` and ``error``.

    The latest successful normalization of a document answers; if it can't be verified the citation
    fails, and no older one takes its place. An unknown or ambiguous block fails too.
    """
    wanted = selectors.select(*DOCUMENT_KEYS).distinct()
    last = latest(normalizations.where("status = 'success'").join(wanted, DOCUMENT_KEYS, "left_semi"), DOCUMENT_KEYS)
    rows = linked(last, ingestions, artifacts)
    asked = selectors.select(F.struct(*[F.col(f"`{c}`") for c in selectors.columns]).alias("asked"), "block_ref")
    joined = asked.join(rows, [F.col(f"asked.{k}") == F.col(f"n.{k}") for k in DOCUMENT_KEYS], "left")
    return _cited(joined, "no successful normalized evidence").select("asked.*", "item", "error")


def document_index(normalizations: DataFrame, ingestions: DataFrame, artifacts: DataFrame, limit: int = 20) -> DataFrame:
    """The latest documents, newest first, with error: a list is good only if no row has one."""
    if limit < 1:
        raise ValueError("limit must be 1 or more")
    rows = linked(latest(normalizations.where("status = 'success'"), DOCUMENT_KEYS), ingestions, artifacts)
    n = lambda c: F.col(f"n.{c}").alias(c)
    extractor = F.struct(F.col("n.extractor_name").alias("name"), F.col("n.extractor_version").alias("version")).alias("extractor")
    out = rows.select(*[n(c) for c in (*DOCUMENT_KEYS, "title", "normalized_at", "classification", "block_count", "char_count", "normalized_sha256")], extractor, F.col("link_error").isNull().alias("verified"), F.col("link_error").alias("error"))
    return out.orderBy(F.desc("normalized_at"), *DOCUMENT_KEYS).limit(limit)


def bundle_of(items: Column) -> Column:
    """A bundle of items in order, with its hash and id."""
    chars = lambda of: F.aggregate(of, F.lit(0).cast("long"), lambda n, x: n + F.length(x["block"]["text"]))
    core = lambda of: {
        "item_count": F.size(of).cast("long"), "items": of, "schema_version": F.lit(BUNDLE_VERSION).cast("long"), "total_chars": chars(of), "trust": F.lit(BUNDLE_TRUST), "type": F.lit(BUNDLE_TYPE),
    }
    return let(items, lambda of: identified(core(of), "bundle_sha256", "bundle_id", "eb-"))


def build_bundles(cited: DataFrame, group: list[str], max_items: int = MAX_ITEMS, max_chars: int = MAX_CHARS) -> DataFrame:
    """``group, bundle, error`` for each group of citations(): the bundle as canonical text, or why there is none.

    Repeated selectors are one item, in whatever order they come. A group beyond its limits is
    refused, never cut: it is counted, and only groups within limits are gathered.
    """
    if not 1 <= max_items <= HARD_ITEMS or not 1 <= max_chars <= HARD_CHARS:
        raise ValueError(f"limits go up to {HARD_ITEMS} items and {HARD_CHARS} characters")
    once = cited.withColumn("text", canonical_text(F.col("item"))).groupBy(*group, F.col("item.evidence_id").alias("eid")).agg(F.min("text").alias("low"), F.max("text").alias("high"), F.min("error").alias("error"), F.first("item").alias("item"))
    found = once.groupBy(*group).agg(F.min("error").alias("failed"), F.count("eid").alias("n"), F.sum(F.length("item.block.text")).alias("chars"), F.max(F.col("low") != F.col("high")).alias("collides"))
    rules = [("evidence id collision", ~F.coalesce("collides", F.lit(False))), ("a bundle requires a citation", F.col("n") > 0), ("too many items", F.col("n") <= max_items), ("too many characters", F.col("chars") <= max_chars)]
    checked = found.withColumn("error", F.coalesce("failed", first_broken(rules))).select(*group, "error")
    item = F.col("item")
    order = F.struct(item["document"]["source_id"], item["document"]["requested_url"], item["provenance"]["normalization_observation_id"], item["block"]["ref"], item.alias("item"))
    kept = once.where("eid is not null").join(checked.where("error is null").select(*group), group, "left_semi")
    made = kept.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["item"]).alias("items"))
    return checked.join(made.select(*group, canonical_text(bundle_of(F.col("items"))).alias("bundle")), group, "left").select(*group, "bundle", "error")


def bundle_error(text: Column) -> Column:
    """What is wrong with the text of a bundle alone, or null."""
    return let(parsed(text, BUNDLE), lambda b: let(bundle_of(b["items"]), lambda again: first_broken(_bundle_rules(text, b, again))))


def _bundle_rules(text: Column, b: Column, again: Column) -> list[tuple[str, Column]]:
    items = b["items"]
    each = lambda ok: F.forall(items, lambda x: F.coalesce(ok(x), F.lit(False)))
    all_of = lambda x: first_broken(identity_rules(x["document"], x["block"], x["provenance"])).isNull()
    return [
        ("bundle does not have exactly its fields", has_shape(text, b)),
        ("unsupported bundle schema version", b["schema_version"] == BUNDLE_VERSION),
        ("bundle type must be evidence_bundle", b["type"] == BUNDLE_TYPE),
        ("bundle trust must be external_data_only", b["trust"] == BUNDLE_TRUST),
        ("bundle requires items", F.size(items) > 0),
        ("bundle exceeds the hard item limit", F.size(items) <= HARD_ITEMS),
        ("item_count does not match items", b["item_count"] == F.size(items)),
        ("every item must be external evidence, data and not instructions", each(lambda x: (x["type"] == EVIDENCE_TYPE) & (x["trust"] == EVIDENCE_TRUST))),
        ("an item has no evidence identity", each(all_of)),
        ("evidence_id does not match its identity", each(lambda x: x["evidence_id"] == evidence_id(x["document"], x["block"], x["provenance"]))),
        ("an item has no text", each(lambda x: x["block"]["text"] != "")),
        ("duplicate evidence id", distinct(F.transform(items, lambda x: x["evidence_id"]))),
        ("bundle exceeds the hard character limit", again["total_chars"] <= HARD_CHARS),
        ("total_chars does not match the text", b["total_chars"] == again["total_chars"]),
        ("bundle SHA-256 does not match its content", b["bundle_sha256"] == again["bundle_sha256"]),
        ("bundle_id does not match its SHA-256", b["bundle_id"] == again["bundle_id"]),
    ]


def verify_bundles(bundles: DataFrame, normalizations: DataFrame, ingestions: DataFrame, artifacts: DataFrame, bundle: str = "bundle", key: list[str] | None = None) -> DataFrame:
    """bundles with error: null if each item is what its pinned observation holds today.

    key names the columns that tell bundles apart. Items are checked against the very observation
    that they name, however many came after it. All items of all bundles meet the ledgers in one
    join; artifacts that no item names are not read. Bundles are checked alone once, and written with
    the outcome, since the plan reads them three times.
    """
    key = key or [c for c in bundles.columns if c != bundle]
    shaped, _ = saved(bundles.withColumn("shape_error", bundle_error(F.col(bundle))), "shaped")
    good = shaped.where("shape_error is null").select(F.struct(*key).alias("own"), F.explode(parsed(F.col(bundle), BUNDLE)["items"]).alias("claimed"))
    asked = good.select("*", F.col("claimed.provenance.normalization_observation_id").alias("pinned"), F.col("claimed.block.ref").alias("block_ref"))
    pins = asked.select(F.col("pinned").alias("id")).distinct()
    rows = linked(normalizations.join(pins, "id", "left_semi"), ingestions, artifacts)
    met = _cited(asked.join(rows, F.col("pinned") == F.col("n.id"), "left"), "pinned observation is missing or not successful")
    differs = F.when(canonical_text(F.col("item")) != canonical_text(F.col("claimed")), F.lit("bundled evidence no longer matches the pinned evidence"))
    failed = met.select(*[F.col(f"own.{k}").alias(k) for k in key], F.coalesce("error", differs).alias("item_error")).where("item_error is not null").groupBy(*key).agg(F.min("item_error").alias("item_error"))
    same = reduce(and_, [F.col(f"b.{k}").eqNullSafe(F.col(f"f.{k}")) for k in key])
    return shaped.alias("b").join(failed.alias("f"), same, "left").select(*[F.col(f"b.{c}") for c in bundles.columns], F.coalesce("b.shape_error", "f.item_error").alias("error"))
