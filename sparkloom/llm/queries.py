"""The operators' queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.pii import find_personal_data

    return find_personal_data(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.token_files import token_round_trip

    return token_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 1)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.decontaminate import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.near_dedup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.nearest import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 2)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.fim import fim_round_trip

    return fim_round_trip(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.merkle import tampered_check

    return tampered_check(table(spark, sf_dir, "documents"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.llm.repeats import repeat_digests

    return repeat_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_pii, op2_token_files, op3_decontaminate, op4_sharding, op5_language, op6_warc, op7_licenses, op8_near_dedup, op9_nearest, op10_packing, op11_fim, op12_merkle, op13_repeats)
    return {f.__name__: f for f in found}


_WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS keep FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
 CASE WHEN page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM p LEFT JOIN g USING (html)"""
_NEAREST_SQL = """WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CONTAMINATION_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item, n, w[k : k + n - 1] AS p FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
x AS (SELECT r, n, k, w[k : k + n - 1] AS p FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
h AS (SELECT r, x.n, k, item FROM x JOIN p ON x.n = p.n AND x.p = p.p),
c AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS j FROM (SELECT DISTINCT r, n, k FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)"""
_DUPLICATES_SQL = rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER_SQL}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[k : k + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
b AS (SELECT x.r AS a, y.r AS b, count(*) AS shared FROM s x JOIN s y ON x.s = y.s AND x.r <> y.r GROUP BY ALL),
l AS (SELECT a, b FROM b JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach(r, m) AS (SELECT r, r FROM d UNION SELECT l.b, reach.m FROM reach JOIN l ON l.a = reach.r),
c AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.m GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d JOIN c USING (r) LEFT JOIN n USING (r)"""


def _licences_sql() -> str:
    """Every template against every text, shingle by shingle."""
    from sparkloom.llm.licenses import LEAST_SHARE, TEMPLATES, WORDS

    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in TEMPLATES.items())
    words = "regexp_extract_all(lower(text), '[a-z0-9]+')"
    return f"""WITH t AS (SELECT license, {words} AS w, least({WORDS}, len({words})) AS size FROM (VALUES {known}) v(license, text)),
p AS (SELECT DISTINCT license, size, array_to_string(w[k : k + size - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM t)),
n AS (SELECT license, count(*) AS n_shingles FROM p GROUP BY license),
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
x AS (SELECT r, size, k, array_to_string(w[k : k + size - 1], ' ') AS s FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM p) WHERE len(w) >= size)),
h AS (SELECT r, license, count(DISTINCT x.s) AS n_held, min(k) - 1 AS start_word FROM x JOIN p ON x.size = p.size AND x.s = p.s GROUP BY ALL)
SELECT doc_id, license, n_held, n_shingles, n_held / n_shingles AS share, start_word FROM h JOIN n USING (license) JOIN d USING (r) WHERE n_held >= {LEAST_SHARE} * n_shingles"""


_FIM_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT doc_id, t, u, len(u) AS n, [('0x' || h[8 * i + 1 : 8 * i + 8])::UBIGINT for i in range(4)] AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
x AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM x"""


#: Of the decimal id: its characters enter one by one, each followed by eight shifts.
_CRC32_SQL = """xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
 lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""


def _merkle_sql(levels: int = 7) -> str:
    """The trees level by level, for groups of at most 16 ** levels leaves; every leaf looks its run up at each level."""
    field = lambda x: f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def forest(name: str, start: str) -> str:
        out = [f"{name}0 AS MATERIALIZED ({start})"]
        for k in range(levels):
            out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT tree, i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (any_value(n) + 15) // 16 AS n, any_value(n) > 1 AS run, string_agg(h, '' ORDER BY i) AS kids FROM {name}{k} GROUP BY tree, i // 16)")
        return ",\n".join(out)

    def climb(start: str, name: str, tree: str, at: str) -> tuple[str, str]:
        steps, last = [], start
        for k in range(levels):
            left, right = f"kids[1 : 64 * ((p.{at} // {16**k}) % 16)]", f"kids[64 * ((p.{at} // {16**k}) % 16) + 65 :]"
            steps.append(f"{start}{name}{k} AS MATERIALIZED (SELECT p.* REPLACE (CASE WHEN r.run THEN sha256({left} || now || {right}) ELSE now END AS now, CASE WHEN r.run THEN proof || {left} || {right} ELSE proof END AS proof) FROM {last} p JOIN {name}{k + 1} r ON r.tree = p.{tree} AND r.i = p.{at} // {16 ** (k + 1)})")
            last = f"{start}{name}{k}"
        return ",\n".join(steps), last

    lower_steps, below = climb("p", "t", "tree", "i")
    upper_steps, done = climb(below, "u", "zero", "tree")
    return f"""WITH f AS (SELECT doc_id, {leaf("text")} AS leaf, CASE WHEN {_CRC32_SQL} % 5 = 0 THEN {leaf(lower)} END AS changed,
 dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, source FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM f),
{forest("t", "SELECT tree, i, leaf AS h, n, false AS run, '' AS kids FROM l")},
{forest("u", f"SELECT 0 AS tree, tree AS i, h, count(*) OVER () AS n, false AS run, '' AS kids FROM t{levels}")},
p AS (SELECT doc_id, leaf, tree, i, 0 AS zero, coalesce(changed, leaf) AS now, '' AS proof FROM l),
{lower_steps},
{upper_steps}
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = r.h AS verified FROM {done} p JOIN t{levels} s USING (tree) CROSS JOIN u{levels} r"""


#: Every string of 400 bytes, by its digest; runs of starts that lie at most 400 apart are one removed run.
_REPEATS_SQL = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, i, md5(array_slice(b, i, i + 399)) AS h FROM (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS i FROM d WHERE octet_length(b) >= 400)),
s AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS step FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
g AS (SELECT r, i, count(*) FILTER (step IS NULL OR step > 400) OVER (PARTITION BY r ORDER BY i) AS k FROM s),
e AS (SELECT r, k, min(i) AS a, max(i) + 399 AS z FROM g GROUP BY r, k),
c AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS o FROM e),
p AS (SELECT r, o AS a, a - 1 AS z FROM c UNION ALL SELECT r, max(z) + 1, octet_length(any_value(b)) FROM c JOIN d USING (r) GROUP BY r),
k AS (SELECT r, sha256(unhex(coalesce(string_agg(hex(array_slice(b, a, z)), '' ORDER BY a) FILTER (z >= a), ''))) AS h FROM p JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(z - a + 1)::BIGINT AS n_removed, count(*) AS n_spans FROM e GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(k.h, sha256(b)) AS kept_sha256 FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express a query; the others are tested against plain restatements."""
    return {"op3_decontaminate": _CONTAMINATION_SQL, "op6_warc": _WARC_SQL, "op7_licenses": _licences_sql(), "op8_near_dedup": _DUPLICATES_SQL, "op9_nearest": _NEAREST_SQL, "op11_fim": _FIM_SQL, "op12_merkle": _merkle_sql(), "op13_repeats": _REPEATS_SQL}
