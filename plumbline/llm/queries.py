"""The corpus operators bound to the test tables."""

from __future__ import annotations

import functools

import corpus_pipeline
from plumbline.llm import bpe, divergence, jaccard, langid, manifest, packing, personal, quality, secrets, suffixes, topk, toxicity, warc
from plumbline.llm.frames import table
from plumbline.queries.registration import Registry

query = Registry()


@functools.cache
def vocabulary() -> str:
    """Path of the public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Null texts and payloads are empty; the digest is that of the full payload.
_ARCHIVED = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, upper(sha1(payload)) AS hexed FROM p),
b AS (SELECT page_id, payload_bytes, hexed, array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
          (CAST('0x' || substr(hexed, 5 * (i // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)
        FOR i IN range(0, 32)], '') AS payload_digest FROM d),
r AS (SELECT *, max(page_id) OVER (PARTITION BY hexed, payload_bytes) AS first FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM r
"""


@query(_ARCHIVED)
def op1_warc(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@query()
def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op4_best_fit_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"), vocabulary())


# Words are cut at ASCII white space, in lower case for A-Z. Links come from shared shingles, components from the
# smallest id reachable, step by step.
_COMPONENTS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query(_COMPONENTS)
def op5_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op6_suffix_dedup(spark, sf_dir):
    return suffixes.removal_digests(table(spark, sf_dir, "documents"))


_PRODUCTS = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query(_PRODUCTS)
def op7_top_products(spark, sf_dir):
    return topk.top_products(table(spark, sf_dir, "embeddings"))


# The four shares with the percentile of their tail, the bucket of a value, and the cutoffs of each level bounded by the level above.
_VERDICTS = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '<null>') AS lang, coalesce(source, '<null>') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, [x FOR x IN string_split_regex(text, '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM t),
windows AS (
  SELECT r, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS g
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w)),
repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (
  SELECT w.r, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM w LEFT JOIN repeats ON repeats.r = w.r LEFT JOIN lines ON lines.r = w.r),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CAST(1000 * n_symbols // greatest(word_chars, 1) AS BIGINT) AS s_symbols, CAST(1000 * n_capitals // greatest(word_chars, 1) AS BIGINT) AS s_capitals,
    CAST(1000 * n_dup_lines // greatest(n_lines, 1) AS BIGINT) AS s_dup_lines, CAST(1000 * n_repeat_words // greatest(n_words, 1) AS BIGINT) AS s_repeats
  FROM c),
v AS (
  SELECT r, lang, source, base_failed, e.share, e.v, e.tail,
    e.v - e.v % (CASE WHEN e.v < 32 THEN 1 WHEN e.v < 64 THEN 2 WHEN e.v < 128 THEN 4 WHEN e.v < 256 THEN 8 WHEN e.v < 512 THEN 16 ELSE 32 END) AS bucket
  FROM (SELECT r, lang, source, base_failed, unnest([
    {'share': 'symbols', 'v': s_symbols, 'tail': 90}, {'share': 'capitals', 'v': s_capitals, 'tail': 99},
    {'share': 'dup_lines', 'v': s_dup_lines, 'tail': 99}, {'share': 'repeats', 'v': s_repeats, 'tail': 99}]) AS e FROM f)),
q0 AS (SELECT lang, source, share, list_sort(list(bucket)) AS b FROM v WHERE NOT base_failed GROUP BY ALL),
q1 AS (SELECT lang, share, list_sort(list(bucket)) AS b FROM v WHERE NOT base_failed GROUP BY ALL),
q2 AS (SELECT share, list_sort(list(bucket)) AS b FROM v WHERE NOT base_failed GROUP BY ALL),
cuts AS (
  SELECT v.r, v.v, len(q0.b) AS n0, len(q1.b) AS n1,
    q0.b[(tail * len(q0.b) + 99) // 100] + (q0.b[(tail * len(q0.b) + 99) // 100] - q0.b[(50 * len(q0.b) + 99) // 100]) // 2 + 5 AS c0,
    q1.b[(tail * len(q1.b) + 99) // 100] + (q1.b[(tail * len(q1.b) + 99) // 100] - q1.b[(50 * len(q1.b) + 99) // 100]) // 2 + 5 AS c1,
    q2.b[(tail * len(q2.b) + 99) // 100] + (q2.b[(tail * len(q2.b) + 99) // 100] - q2.b[(50 * len(q2.b) + 99) // 100]) // 2 + 5 AS c2
  FROM v LEFT JOIN q0 ON q0.lang = v.lang AND q0.source = v.source AND q0.share = v.share
  LEFT JOIN q1 ON q1.lang = v.lang AND q1.share = v.share LEFT JOIN q2 ON q2.share = v.share WHERE NOT v.base_failed),
bounded AS (SELECT *, CASE WHEN n1 >= 200 THEN least(c1, 2 * c2) ELSE c2 END AS b1 FROM cuts),
passed AS (SELECT r, bool_and(v <= CASE WHEN n0 >= 200 THEN least(c0, 2 * b1) ELSE b1 END) AS within FROM bounded GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(within, false) AS kept,
  s_symbols, s_capitals, s_dup_lines, s_repeats FROM f LEFT JOIN passed ON passed.r = f.r
"""


@query(_VERDICTS)
def op8_quality_rules(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


@query()
def op9_language_id(spark, sf_dir):
    return langid.languages(table(spark, sf_dir, "documents"))


@query()
def op10_bpe_encoding(spark, sf_dir):
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), vocabulary())


@query()
def op2_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query()
def op11_personal_data(spark, sf_dir):
    return personal.scan(table(spark, sf_dir, "documents"))


# Nodes are numbered from 0 in each tree and level; a row climbs its source's tree, then that of the sources.
_MANIFEST = """
WITH RECURSIVE c AS (
  SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten([
      [CAST(unicode(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
      FOR i IN range(1, length(CAST(doc_id AS VARCHAR)) + 1)])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) AS crc FROM documents),
e AS (
  SELECT doc_id, source, coalesce(strlen(source) || ':' || source, '-') AS k,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text,
    CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM c),
l AS (
  SELECT doc_id, source, k, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS found FROM e),
b AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY k) AS m FROM l),
up AS (
  SELECT k, 0 AS level, place AS i, leaf AS digest, m FROM b
  UNION ALL SELECT k, level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (any_value(m) + 15) // 16 FROM up WHERE m > 1 GROUP BY k, level, i // 16),
s AS (
  SELECT k, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS m
  FROM (SELECT DISTINCT k, source FROM b) JOIN up USING (k) WHERE up.m = 1),
top AS (
  SELECT 0 AS level, place AS i, digest, m FROM s
  UNION ALL SELECT level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (any_value(m) + 15) // 16 FROM top WHERE m > 1 GROUP BY level, i // 16),
runs AS (
  SELECT k, level, i // 16 AS run, list(digest ORDER BY i) AS members FROM (SELECT * FROM up UNION ALL SELECT '', * FROM top) WHERE m > 1 GROUP BY ALL),
climb AS (
  SELECT r, b.k, 0 AS level, b.place AS i, b.m, found AS folded, '' AS siblings, s.place AS then_i, s.m AS then_m FROM b JOIN s USING (k)
  UNION ALL
  SELECT r, CASE WHEN m = 1 THEN '' ELSE c.k END, CASE WHEN m = 1 THEN 0 ELSE c.level + 1 END, CASE WHEN m = 1 THEN then_i ELSE i // 16 END,
    CASE WHEN m = 1 THEN then_m ELSE (m + 15) // 16 END,
    CASE WHEN m = 1 THEN folded ELSE sha256(array_to_string(members[:i % 16], '') || folded || array_to_string(members[i % 16 + 2:], '')) END,
    CASE WHEN m = 1 THEN siblings ELSE siblings || array_to_string(members[:i % 16], '') || array_to_string(members[i % 16 + 2:], '') END, then_i, then_m
  FROM climb c LEFT JOIN runs ON runs.k = c.k AND runs.level = c.level AND runs.run = i // 16 WHERE NOT (c.k = '' AND m = 1))
SELECT b.doc_id, b.leaf, s.digest AS subroot, t.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM climb JOIN b USING (r) JOIN s ON s.k = b.k CROSS JOIN (SELECT digest FROM top WHERE m = 1) t WHERE climb.k = '' AND climb.m = 1
"""


@query(_MANIFEST)
def op12_merkle_manifest(spark, sf_dir):
    return manifest.audited(table(spark, sf_dir, "documents"))


_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT lang, source, term, count(*) AS c FROM t GROUP BY ALL),
c AS (
  SELECT g.lang, g.source, k.term, k.total, coalesce(o.c, 0) AS c FROM g JOIN k ON k.lang = g.lang
  LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (
  SELECT c.lang, c.source, c.term, c.c, 1 + CAST(1000000000 AS HUGEINT) * (c.c + 5) // CAST(n.n + 5 * v.v AS HUGEINT) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (c.total + 5) // CAST(v.n + 5 * v.v AS HUGEINT) AS q
  FROM c JOIN n ON n.lang = c.lang AND n.source = c.source JOIN v ON v.lang = c.lang),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g JOIN g h ON h.lang = g.lang AND h.source <> g.source LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query(_DIVERGENCE)
def op13_source_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
