"""DuckDB SQL for the queries that SQL can express: each contract restated without its method."""

from __future__ import annotations

from corpusmill.llm.licenses import WORD
from corpusmill.llm.licenses import oracle as licenses

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOW = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_SPACED = r"[^\x20\x09-\x0D]+"

SUBSTRINGS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
win AS (SELECT r, s, md5(array_to_string(w[s + 1 : s + 35], ' ')) AS k FROM (SELECT r, w, unnest(range(0, len(w) - 34)) AS s FROM d WHERE len(w) >= 35)),
rep AS (SELECT r, s FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM rep),
gones AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
word AS (SELECT r, unnest(range(0, len(w))) AS p, unnest(w) AS x FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN gones USING (r) LEFT JOIN kept USING (r)"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(e, lambda x: abs(x))) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN root ON root.a = vec_id LEFT JOIN n ON n.a = vec_id"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_SPACED}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 3], ' ') AS k FROM (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * shared.n >= 90 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(size.n, 0)::BIGINT AS n_shingles, component_id FROM d JOIN root ON root.a = doc_id LEFT JOIN size USING (doc_id)"""

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '{WORD}') AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOW}, '{WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item, n, array_to_string(w[s + 1 : s + n], ' ') AS k FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS s FROM i WHERE len(w) > 0)),
run AS (SELECT r, n, s, array_to_string(w[s + 1 : s + n], ' ') AS k FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
hit AS (SELECT r, s, n, item FROM run JOIN win USING (n, k)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item) FILTER (WHERE item IS NOT NULL)), ',') AS items FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN found USING (r)"""

DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOW}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, term, count(*) AS c FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(c) AS c FROM t GROUP BY ALL HAVING count(*) >= 3),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY ALL),
x AS (SELECT g.lang, g.source, k.term, k.c AS in_lang, coalesce(o.c, 0) AS c
  FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, sum(c) AS c FROM t GROUP BY ALL) o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
p AS (SELECT x.lang, x.source, x.term, x.c, 1 + 1000000000::HUGEINT * (x.c + 1) // (sum(x.c) OVER (PARTITION BY x.lang, x.source) + v.v) AS p, 1 + 1000000000::HUGEINT * (x.in_lang + 1) // (v.n + v.v) AS q FROM x JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM f QUALIFY part = 'pair' OR rank <= 200"""

SQL = {
    "op1_substring_dedup": SUBSTRINGS,
    "op2_embedding_near_dedup": VECTORS,
    "op3_ngram_jaccard_join": JACCARD,
    "op7_benchmark_decontamination": DECONTAMINATION,
    "op8_license_scans": licenses(),
    "op11_source_divergence": DIVERGENCE,
}
