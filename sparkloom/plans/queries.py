"""Queries over the test tables, each with the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import provenance as pv
from sparkloom.functions import text as tx
from sparkloom.functions import urls
from sparkloom.operators import blocks, dataset, evidence, ledger, registry
from sparkloom.plans import evidence_queries
from sparkloom.tables import discard, saved, shuffles_dropped

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _headlines(spark, d) -> DataFrame:
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", F.col("lang").alias("label"), F.concat(F.substring_index("text", "\n", 1), F.lit(" - "), "source").alias("title"))


_CLEAN = r"""trim(regexp_replace(regexp_replace(split_part(text, chr(10), 1) || ' - ' || source, '\s+-\s+[^-]{2,60}$', ''), '\s+', ' ', 'g'))"""
_H = f"h AS (SELECT doc_id, lang AS label, {_CLEAN} AS title FROM documents)"
_KEYED = f"{_H}, k AS (SELECT *, replace(strip_accents(lower(title)), 'ß', 'ss') AS key FROM h WHERE title <> '')"
_FIRST = f"{_KEYED}, u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1)"


@query(f"WITH {_H} SELECT doc_id, label, title FROM h WHERE title <> ''")
def headline_clean(spark, d):
    return tx.normalize_titles(_headlines(spark, d), "title").where("title <> ''").select("doc_id", "label", "title")


def _unique(spark, d) -> DataFrame:
    return dataset.keep_first(headline_clean(spark, d).withColumn("key", tx.dedupe_key(F.col("title"))), "key", "doc_id")


@query(f"WITH {_FIRST} SELECT doc_id, label, key FROM u")
def headline_dedupe(spark, d):
    return _unique(spark, d).select("doc_id", "label", "key")


@query(f"WITH {_FIRST} SELECT label, count(*) AS n FROM u GROUP BY label HAVING count(*) >= 15")
def class_filter(spark, d):
    return dataset.frequent_classes(_unique(spark, d), "label").groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang AS label, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY sha256('42:' || doc_id)) <= ceil(0.25 * count(*) OVER (PARTITION BY lang)) THEN 'test' ELSE 'train' END AS split FROM documents")
def stratified_split(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.col("lang").alias("label"))
    return dataset.stratified_split(rows, "label", F.col("doc_id").cast("string")).select("doc_id", "label", "split")


def _ruled(spark, d) -> DataFrame:
    t = F.col("text")
    rule = F.when(F.contains(t, F.lit(" the ")), "en").when(F.contains(t, F.lit(" der ")), "de").when(F.contains(t, F.lit(" que ")), "es").otherwise("fr")
    return _t(spark, d, "documents").select("doc_id", F.col("lang").alias("label"), rule.alias("prediction"))


_RULED = "p AS (SELECT lang AS label, CASE WHEN contains(text, ' the ') THEN 'en' WHEN contains(text, ' der ') THEN 'de' WHEN contains(text, ' que ') THEN 'es' ELSE 'fr' END AS prediction FROM documents)"
_MAJOR = "p AS (SELECT lang AS label, (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS prediction FROM documents)"
_SCORES = """l AS (SELECT label FROM p UNION SELECT prediction FROM p),
c AS (SELECT l.label, (SELECT count(*) FROM p WHERE p.label = l.label) AS support, (SELECT count(*) FROM p WHERE p.prediction = l.label) AS chosen,
 (SELECT count(*) FROM p WHERE p.label = l.label AND p.prediction = l.label) AS hit FROM l),
r AS (SELECT label, support, coalesce(hit / nullif(chosen, 0), 0.0) AS precision, coalesce(hit / nullif(support, 0), 0.0) AS recall FROM c),
s AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM r)"""
_REPORT = "SELECT (SELECT count(*) FROM p) AS n, round((SELECT avg((label = prediction)::int) FROM p), 4) AS accuracy, round(avg(precision), 4) AS macro_precision, round(avg(recall), 4) AS macro_recall, round(avg(f1), 4) AS macro_f1 FROM s"


@query(f"WITH {_MAJOR}, {_SCORES} {_REPORT}")
def majority_report(spark, d):
    docs = _t(spark, d, "documents").select(F.col("lang").alias("label"))
    return dataset.report(docs.join(F.broadcast(dataset.majority(docs, "label")), F.lit(True)))


@query(f"WITH {_RULED}, {_SCORES} {_REPORT}")
def rule_report(spark, d):
    return dataset.report(_ruled(spark, d))


@query(f"WITH {_RULED}, {_SCORES} SELECT label, support, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1 FROM s WHERE support > 0")
def class_report(spark, d):
    out = dataset.class_scores(_ruled(spark, d)).where("support > 0")
    return out.select("label", "support", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


@query(f"WITH {_RULED}, l AS (SELECT DISTINCT label FROM p) SELECT a.label AS truth, b.label AS predicted, (SELECT count(*) FROM p WHERE p.label = a.label AND p.prediction = b.label) AS n FROM l a, l b")
def confusion_matrix(spark, d):
    return dataset.confusion(_ruled(spark, d))


@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(coalesce(text, ''))), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS term FROM w UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1),
c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM c GROUP BY term),
x AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM c JOIN f USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 5) AS weight FROM x""")
def tfidf_weights(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return dataset.tfidf(docs, "doc_id", "text").select("doc_id", "term", F.round("weight", 5).alias("weight"))


@query()
def logistic_predictions(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.col("lang").alias("label"), "text")
    with shuffles_dropped(spark):
        split, path = saved(dataset.stratified_split(rows, "label", F.col("doc_id").cast("string")), "split")
        names = [r["label"] for r in split.groupBy("label").count().orderBy("label").collect()]
        indexed = split.withColumn("y", F.array_position(F.array(*[F.lit(x) for x in names]), F.col("label")).cast("double") - 1)
        model = dataset.fit_logistic(dataset.balanced_weights(indexed.where("split = 'train'"), "label"), "y", "text")
        out = model.transform(indexed.where("split = 'test'"))  # saves its rows
        discard(spark, path)
    return out.select("doc_id", "label", F.element_at(F.array(*[F.lit(x) for x in names]), F.col("prediction").cast("int") + 1).alias("prediction"))


_URL = r"regexp_replace(url, '#.*$', '')"


@query(f"SELECT page_id, {_URL} AS url, lower(regexp_extract(url, '://([^/?#:]+)', 1)) AS host, starts_with(url, 'https://') AS https, regexp_extract(url, '^([a-z]+://[^/]+)', 1) || '/robots.txt' AS robots FROM pages")
def page_urls(spark, d):
    u = urls.normalize_absolute(F.col("url"))
    return _t(spark, d, "pages").select("page_id", u.alias("url"), urls.host_of(u).alias("host"), urls.is_https(u).alias("https"), urls.robots_url(u).alias("robots"))


def _registry(pages: DataFrame) -> DataFrame:
    """A source for each top-level domain of the pages' hosts: official if it is .org or .com."""
    u = urls.normalize_absolute(F.col("url"))
    tld = F.regexp_extract(u, r"\.([a-z]+)/", 1)
    return pages.select(u.alias("url"), tld.alias("source_id"), F.array(urls.host_of(u)).alias("domains"), F.array(F.concat(F.regexp_extract(u, r"^([a-z]+://[^/]+)", 1), F.lit("/en"))).alias("prefixes"), "page_id")


@query(rf"SELECT page_id, regexp_extract({_URL}, '\.([a-z]+)/', 1) AS source_id FROM pages WHERE starts_with(url, 'https://') AND regexp_extract({_URL}, '\.([a-z]+)/', 1) <> 'net' AND regexp_matches(url, '^https://[^/]+/en')")
def allowlist_filter(spark, d):
    rows = _registry(_t(spark, d, "pages"))
    ok = urls.is_allowed_candidate(F.col("url"), F.lit(True), F.col("source_id") != "net", F.col("domains"), F.col("prefixes"))
    return rows.where(ok).select("page_id", "source_id")


@query(r"""WITH a AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS root, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
u AS (SELECT page_id, CASE WHEN starts_with(href, '/') THEN root || href ELSE href END AS u FROM a WHERE href <> '')
SELECT DISTINCT page_id, regexp_replace(replace(u, '&amp;', '&'), '#.*$', '') AS link FROM u""")
def page_links(spark, d):
    from sparkloom.sources.html import page_links as links

    rows = links(_t(spark, d, "pages"), ["page_id", "url"], "html")
    return rows.select("page_id", urls.normalize_url("url", "href").alias("link")).where("link is not null").distinct()


_LINKS = r"""a AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS root, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
l AS (SELECT DISTINCT page_id, regexp_replace(replace(CASE WHEN starts_with(href, '/') THEN root || href ELSE href END, '&amp;', '&'), '#.*$', '') AS url FROM a WHERE href <> '')"""


@query(rf"""WITH {_LINKS}, s AS (SELECT l.*, regexp_extract(url, '\.([a-z]+)/', 1) AS source_id, lower(regexp_extract(url, '://([^/?#:]+)', 1)) AS host FROM l),
r AS (SELECT regexp_extract({_URL}, '\.([a-z]+)/', 1) AS source_id, lower(regexp_extract(url, '://([^/?#:]+)', 1)) AS host, regexp_extract({_URL}, '^([a-z]+://[^/]+/[^/?]*)', 1) AS prefix FROM pages),
h AS (SELECT DISTINCT source_id, host FROM r), p AS (SELECT DISTINCT source_id, prefix FROM r)
SELECT page_id, source_id, url FROM s WHERE starts_with(url, 'https://') AND source_id <> 'net' AND EXISTS (SELECT 1 FROM h WHERE h.source_id = s.source_id AND h.host = s.host)
AND EXISTS (SELECT 1 FROM p WHERE p.source_id = s.source_id AND starts_with(s.url, p.prefix))""")
def links_allowed(spark, d):
    """The links of all pages that a registry allows: a source for each top-level domain, a row of it for each page."""
    from sparkloom.operators.allowlist import allowed_urls

    tld = lambda u: F.regexp_extract(u, r"\.([a-z]+)/", 1)
    u = urls.normalize_absolute(F.col("url"))
    prefix = F.regexp_extract(u, r"^([a-z]+://[^/]+/[^/?]*)", 1)
    registry = _t(spark, d, "pages").select(tld(u).alias("id"), F.lit(True).alias("enabled"), (tld(u) != "net").alias("official"), F.array(urls.host_of(u)).alias("domains"), F.array(prefix).alias("allowed_url_prefixes"))
    links = page_links(spark, d).withColumnRenamed("link", "url").withColumn("source_id", tld(F.col("url")))
    return allowed_urls(links, registry).select("page_id", "source_id", "url")


@query(r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<[^>]*>', ' ', 'g'), '&(amp|quot|lt|gt);?', ' ', 'g') AS t FROM pages),
w AS (SELECT page_id, regexp_extract_all(t, '[\p{L}\p{N}]+') AS w FROM a)
SELECT page_id, len(w)::BIGINT AS n_words, sha256(array_to_string(w, ' ')) AS words_sha256 FROM w""")
def page_content(spark, d):
    from sparkloom.sources.html import page_metadata

    words = F.regexp_extract_all("page.markdown", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    rows = page_metadata(_t(spark, d, "pages").select("page_id", "html"), "html").select("page_id", words.alias("w"))
    return rows.select("page_id", F.size("w").cast("long").alias("n_words"), F.sha2(F.concat_ws(" ", "w"), 256).alias("words_sha256"))


@query("SELECT page_id, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS language FROM pages")
def page_languages(spark, d):
    from sparkloom.sources.html import page_metadata

    return page_metadata(_t(spark, d, "pages"), "html").select("page_id", F.col("page.language").alias("language"))


def _runs(spark, d) -> DataFrame:
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return _t(spark, d, "events").select("event_id", F.col("event_type").alias("source_id"), F.col("user_id").alias("url"), F.dayofmonth("ts").alias("run_id"), at.alias("at"))


_RUNS = "r AS (SELECT event_id, event_type AS source_id, user_id AS url, day(ts) AS run_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS seen FROM events)"
_CLASSED = f"WITH {_RUNS}, o AS (SELECT DISTINCT source_id, url, run_id FROM r), c AS (SELECT *, CASE WHEN run_id = min(run_id) OVER (PARTITION BY source_id, url) THEN 'new' ELSE 'known' END AS classification FROM o)"


@query(f"{_CLASSED} SELECT source_id, url, run_id, classification FROM c")
def ledger_new_known(spark, d):
    return ledger.new_or_known(_runs(spark, d), ["source_id", "url"], "run_id")


@query(f"{_CLASSED} SELECT source_id, run_id, count(*) AS candidate_count, count(*) FILTER (classification = 'new') AS new_count, count(*) FILTER (classification = 'known') AS known_count FROM c GROUP BY ALL")
def run_summary(spark, d):
    return ledger.run_summary(ledger_new_known(spark, d), ["source_id", "run_id"])


@query(f"WITH {_RUNS}, o AS (SELECT source_id, url, run_id, min(seen) AS seen FROM r GROUP BY ALL) SELECT source_id, url, arg_min(seen, run_id) AS first_seen_at, arg_max(seen, run_id) AS last_seen_at, count(*) AS seen_count FROM o GROUP BY ALL")
def candidate_ledger(spark, d):
    once = _runs(spark, d).groupBy("source_id", "url", "run_id").agg(F.min("at").alias("at"))
    return ledger.candidates(once, ["source_id", "url"], "run_id", "at")


@query(f"WITH {_RUNS} SELECT url, array_to_string(list_sort(list(DISTINCT source_id)), ',') AS origins FROM r GROUP BY url")
def candidate_origins(spark, d):
    return ledger.origins(_runs(spark, d), ["url"], "source_id").withColumn("origins", F.array_join("origins", ","))


def _observations(spark, d) -> DataFrame:
    bad = F.col("event_type") == "error"
    sha = F.when(~bad, F.sha2(F.floor(F.col("value") / 20).cast("string"), 256))
    return _t(spark, d, "events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("s"), (F.col("user_id") % 7).cast("string")).alias("source_id"), F.col("user_id").cast("string").alias("requested_url"),
        F.when(bad, "error").otherwise("success").alias("status"), sha.alias("sha256"), F.when(bad, "failed").alias("error"), F.when(F.dayofmonth("ts") <= 15, "1").otherwise("2").alias("extractor_version"),
    )


_OBS = "o AS (SELECT event_id AS id, 's' || (user_id % 7) AS source_id, user_id::varchar AS requested_url, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, CASE WHEN event_type <> 'error' THEN sha256(floor(value / 20)::bigint::varchar) END AS sha256, CASE WHEN event_type = 'error' THEN 'failed' END AS error, CASE WHEN day(ts) <= 15 THEN '1' ELSE '2' END AS extractor_version FROM events)"


def _class_sql(keys: str) -> str:
    return f"WITH {_OBS}, g AS (SELECT id, lag(sha256) OVER (PARTITION BY {keys} ORDER BY id) AS before FROM o WHERE status = 'success'), c AS (SELECT o.*, CASE WHEN o.status <> 'success' THEN NULL WHEN before IS NULL THEN 'NEW' WHEN before = sha256 THEN 'UNCHANGED' ELSE 'CHANGED' END AS classification FROM o LEFT JOIN g USING (id))"


_URL_KEYS = ["source_id", "requested_url"]


@query(_class_sql("source_id, requested_url") + " SELECT id, classification FROM c")
def observation_change(spark, d):
    return ledger.change_class(_observations(spark, d), _URL_KEYS, "sha256").select("id", "classification")


@query(_class_sql("source_id, requested_url, extractor_version") + " SELECT id, classification FROM c")
def normalized_change(spark, d):
    return ledger.change_class(_observations(spark, d), [*_URL_KEYS, "extractor_version"], "sha256").select("id", "classification")


@query(_class_sql("source_id, requested_url") + " SELECT source_id, count(*) FILTER (classification = 'NEW') AS n_new, count(*) FILTER (classification = 'UNCHANGED') AS n_unchanged, count(*) FILTER (classification = 'CHANGED') AS n_changed, count(*) FILTER (status = 'error') AS n_error, count(*) FILTER (status = 'error') = 0 AS ok FROM c GROUP BY source_id")
def stage_counts(spark, d):
    return ledger.stage_counts(ledger.change_class(_observations(spark, d), _URL_KEYS, "sha256"), ["source_id"])


@query(f"WITH {_OBS} SELECT source_id, requested_url, id, sha256 FROM o WHERE status = 'success' QUALIFY row_number() OVER (PARTITION BY source_id, requested_url ORDER BY id DESC) = 1")
def latest_success(spark, d):
    return ledger.latest(_observations(spark, d).where("status = 'success'"), _URL_KEYS).select(*_URL_KEYS, "id", "sha256")


@query(f"WITH {_OBS}, s AS (SELECT DISTINCT 's' || (n_nationkey % 9) AS source_id FROM nation) SELECT source_id, coalesce((SELECT arg_max(status, id) FROM o WHERE o.source_id = s.source_id), 'NEVER_RUN') AS ingestion, coalesce((SELECT arg_max(status, id) FROM o WHERE o.source_id = s.source_id AND extractor_version = '1'), 'NEVER_RUN') AS normalization FROM s")
def source_status(spark, d):
    sources = _t(spark, d, "nation").select(F.concat(F.lit("s"), (F.col("n_nationkey") % 9).cast("string")).alias("source_id")).distinct()
    rows = _observations(spark, d)
    return ledger.source_status(sources, "source_id", {"ingestion": rows, "normalization": rows.where("extractor_version = '1'")})


@query(f"WITH {_OBS} SELECT id AS entity_id, 2 AS rule_no FROM o WHERE status = 'success' AND (sha256 IS NULL OR error IS NOT NULL) UNION ALL SELECT id, 3 FROM o WHERE status <> 'success' AND (error IS NULL OR sha256 IS NOT NULL)")
def ledger_violations(spark, d):
    return ledger.violations(_observations(spark, d), F.col("id"), ledger.success_rules()).select("entity_id", "rule_no")


@query("SELECT sha256(text) AS sha256, 'objects/sha256/' || sha256(text)[1:2] || '/' || sha256(text) AS path, strlen(any_value(text)) AS bytes, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text")
def object_store(spark, d):
    rows = _t(spark, d, "documents").where("text is not null").select(F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"))
    out = rows.groupBy("sha256").agg(F.max("bytes").alias("bytes"), F.count("*").alias("n"))
    return out.select("sha256", pv.object_path(F.col("sha256")).alias("path"), "bytes", "n")


def _blocks(spark, d) -> DataFrame:
    rows = blocks.citation_blocks(evidence_queries.turns(spark, d), ["conv_id", "turn"], "md")
    return rows.withColumn("path", F.array_join("heading_path", " > ")).drop("heading_path")


@query(f"WITH {evidence_queries.BLOCKS_SQL} SELECT conv_id, turn, ordinal, ref, kind, path, text FROM k")
def citation_blocks(spark, d):
    return _blocks(spark, d)


@query(f"WITH {_OBS}, l AS (SELECT * FROM o WHERE status = 'success' QUALIFY row_number() OVER (PARTITION BY source_id, requested_url ORDER BY id DESC) = 1) SELECT l.source_id, l.requested_url, l.id, l.id - l.id % 2 AS ingestion_id FROM l JOIN o i ON i.id = l.id - l.id % 2 AND i.status = 'success'")
def evidence_list(spark, d):
    rows = _observations(spark, d)
    normal = rows.withColumns({"ingestion_observation_id": F.col("id") - F.col("id") % 2, "normalized_at": F.col("id").cast("string")})
    return evidence.documents(normal, rows).select("n.source_id", "n.requested_url", "n.id", F.col("i.id").alias("ingestion_id"))


@query(f"""WITH {_OBS}, l AS (SELECT * FROM o WHERE status = 'success' QUALIFY row_number() OVER (PARTITION BY source_id, requested_url ORDER BY id DESC) = 1), j AS (SELECT l.id, l.source_id = i.source_id AS a, l.requested_url = i.requested_url AS b, l.sha256 = i.sha256 AS c FROM l JOIN o i ON i.id = l.id - l.id % 2 AND i.status = 'success')
SELECT id AS entity_id, 1 AS rule_no FROM j WHERE NOT a UNION ALL SELECT id, 2 FROM j WHERE NOT b UNION ALL SELECT id, 3 FROM j WHERE NOT c""")
def provenance_violations(spark, d):
    rows = _observations(spark, d).withColumns({"final_url": F.col("requested_url"), "object_path": F.lit("x")})
    normal = rows.withColumns({"ingestion_observation_id": F.col("id") - F.col("id") % 2, "normalized_at": F.col("id").cast("string"), "raw_sha256": F.col("sha256")})
    return ledger.violations(evidence.documents(normal, rows), F.col("n.id"), evidence.provenance_rules()).select("entity_id", "rule_no")


@query("""WITH v AS (SELECT source, CASE WHEN quality = 1 AND toxic = 0 THEN 'supported' WHEN quality = 0 AND toxic = 0 THEN 'partially_supported' WHEN quality = 1 THEN 'unsupported' ELSE 'unassessable' END AS verdict FROM labels JOIN documents USING (doc_id))
SELECT source, count(*) FILTER (verdict = 'supported') AS n_supported, count(*) FILTER (verdict = 'partially_supported') AS n_partially_supported, count(*) FILTER (verdict = 'unsupported') AS n_unsupported, count(*) FILTER (verdict = 'unassessable') AS n_unassessable, count(*) AS n_claims, count(*) FILTER (verdict <> 'unassessable') AS assessable_claims,
count(*) FILTER (verdict = 'supported') / nullif(count(*) FILTER (verdict <> 'unassessable'), 0) AS supported_precision, count(*) FILTER (verdict = 'unsupported') / nullif(count(*) FILTER (verdict <> 'unassessable'), 0) AS unsupported_rate FROM v GROUP BY source""")
def claim_metrics(spark, d):
    q, t = F.col("quality") == 1, F.col("toxic") == 1
    verdict = F.when(q & ~t, "supported").when(~q & ~t, "partially_supported").when(q, "unsupported").otherwise("unassessable")
    rows = _t(spark, d, "labels").join(_t(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return evidence.review_metrics(rows.select("source", verdict.alias("verdict")), ["source"])


@query("""WITH p AS (SELECT conv_id, turn, text, role FROM conversations) SELECT conv_id || ':' || turn AS entity_id, 2 AS rule_no FROM p WHERE length(text) > 1200 UNION ALL SELECT conv_id || ':' || turn, 3 FROM p WHERE turn % 3 = 0 UNION ALL SELECT conv_id || ':' || turn, 5 FROM p WHERE turn % 3 <> 0 AND role = 'system' UNION ALL SELECT conv_id || ':' || turn, 1 FROM p WHERE trim(text) = ''""")
def proposal_validation(spark, d):
    cites = F.when(F.col("turn") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("role"))
    rows = _t(spark, d, "conversations").select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("e"), F.col("text").alias("claim_text"), cites.alias("citations"))
    known = F.array(F.lit("user"), F.lit("assistant"))
    return ledger.violations(rows, F.col("e"), evidence.proposal_rules(known)).select("entity_id", "rule_no")


@query("""WITH s AS (SELECT n_nationkey AS place, CASE WHEN n_nationkey % 9 = 8 THEN ' ' ELSE 'n' || (n_nationkey % 20) END AS id, n_nationkey % 4 <> 0 AS official, n_nationkey % 3 <> 0 AS enabled, n_nationkey % 7 AS m FROM nation),
d AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY place) AS nth, CASE WHEN trim(id) = '' THEN 'sources[' || place || ']' ELSE id END AS entity_id FROM s)
SELECT entity_id, 1 AS rule_no FROM d WHERE trim(id) = '' UNION ALL SELECT entity_id, 2 FROM d WHERE nth > 1 UNION ALL SELECT entity_id, 3 FROM d WHERE enabled AND NOT official
UNION ALL SELECT entity_id, unnest([4, 7, 8]) FROM d WHERE m = 1 UNION ALL SELECT entity_id, 5 FROM d WHERE m = 2 UNION ALL SELECT entity_id, 6 FROM d WHERE m = 3 UNION ALL SELECT entity_id, 7 FROM d WHERE m = 4 UNION ALL SELECT entity_id, 8 FROM d WHERE m = 5""")
def registry_violations(spark, d):
    k, m = F.col("n_nationkey"), F.col("n_nationkey") % 7
    none, one = F.array().cast("array<string>"), lambda u: F.array(F.lit(u))
    rows = _t(spark, d, "nation").select(
        k.alias("place"), F.when(k % 9 == 8, " ").otherwise(F.concat(F.lit("n"), (k % 20).cast("string"))).alias("id"), (k % 4 != 0).alias("official"), (k % 3 != 0).alias("enabled"),
        F.when(m == 1, none).otherwise(one("X.example.org")).alias("domains"), F.when(m == 2, none).when(m == 4, one("http://x.example.org/")).otherwise(one("https://x.example.org/a")).alias("entrypoints"),
        F.when(m == 3, none).when(m == 5, one("https://y.example.org/")).otherwise(one("https://x.example.org/")).alias("allowed_url_prefixes"),
    )
    return registry.registry_violations(rows).select("entity_id", "rule_no")


@query(f"WITH {_OBS}, l AS (SELECT * FROM o WHERE status = 'success' QUALIFY row_number() OVER (PARTITION BY source_id, requested_url ORDER BY id DESC) = 1) SELECT id, source_id, requested_url FROM l WHERE source_id = 's3' ORDER BY requested_url LIMIT 7")
def latest_ingestions(spark, d):
    rows = ledger.latest(_observations(spark, d).where("status = 'success' AND source_id = 's3'"), _URL_KEYS)
    return rows.orderBy("requested_url").limit(7).select("id", "source_id", "requested_url")


@query("SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang")
def class_distribution(spark, d):
    return dataset.class_distribution(_t(spark, d, "documents").withColumnRenamed("lang", "label"), "label")


for _name, (_made, _sql) in evidence_queries.queries().items():
    _QUERIES[_name], _SQL[_name] = _made, _sql
