"""DuckDB SQL of those queries that it can express."""

from __future__ import annotations

from .chat_format import OP13_SQL
from .conversation_repair import OP11_SQL
from .exact_search import OP7_SQL
from .resampling import OP12_SQL
from .secret_scan import BASE, KINDS, OWNERS
from .warc import OP4_SQL

OP1_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
     s AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
     f AS (SELECT h, min(doc_id) AS lo FROM s GROUP BY h),
     hit AS (SELECT doc_id, i FROM s JOIN f USING (h) WHERE doc_id > lo),
     p AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
     m AS (SELECT p.doc_id, p.i, p.word, count(hit.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone FROM p LEFT JOIN hit USING (doc_id, i)),
     k AS (SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

_KINDS = " UNION ALL ".join(
    f"SELECT doc_id, owner, {n} AS r, '{name}' AS name, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g, list_transform(regexp_extract_all(text, '{p}'), lambda x: regexp_extract(x, '{p}', {group})) AS v, {least} AS least FROM d"
    for n, (name, p, group, least) in enumerate((name, p.replace("'", "''"), group, least) for name, p, group, least in KINDS)
)
OP5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text FROM documents), k AS ({_KINDS}),
     u AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM k WHERE len(m) > 0),
     s AS (SELECT doc_id, owner, r, name, v[i] AS value, least, CAST(list_sum(list_transform(g[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(m[i]) AS n FROM u),
     t AS (SELECT *, name || ':' || a || ':' || (a + n) AS span FROM s WHERE length(value) >= least),
     o AS (SELECT value, count(DISTINCT owner) AS owners FROM t GROUP BY value),
     j AS (SELECT t.*, owners < {OWNERS} AS live FROM t JOIN o USING (value)),
     x AS (SELECT doc_id, count(*) FILTER (r = 0) AS n_assign, count(*) FILTER (r = 1) AS n_access, count(*) FILTER (r = 2) AS n_hex, string_agg(span, ',' ORDER BY a, r) FILTER (r < {BASE}) AS base,
                  string_agg(span, ',' ORDER BY a, r) AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example, string_agg(span, ',' ORDER BY a, r) FILTER (live) AS live_spans FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(live_spans, '') AS live_spans FROM d LEFT JOIN x USING (doc_id)
"""

OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
     g AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
     n AS (SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS h, s FROM g),
     c AS (SELECT h, min(doc_id) AS rep, count(*) AS copies FROM n WHERE n > 0 GROUP BY h),
     e AS (SELECT rep, n, unnest(s) AS x FROM n JOIN c ON n.h = c.h AND n.doc_id = c.rep),
     pairs AS (SELECT p.rep AS a, q.rep AS b, count(*) AS k, any_value(p.n + q.n) AS t FROM e p JOIN e q ON p.x = q.x AND p.rep < q.rep GROUP BY 1, 2),
     l AS (SELECT a, b FROM pairs WHERE 100 * k >= 90 * (t - k)), b AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
     r AS (SELECT rep AS node, rep AS comp FROM c UNION SELECT b.b, r.comp FROM r JOIN b ON b.a = r.node AND r.comp < b.b),
     w AS (SELECT b.a AS rep, CAST(sum(c.copies) AS BIGINT) AS w FROM b JOIN c ON c.rep = b.b GROUP BY 1),
     m AS (SELECT node, min(comp) AS comp FROM r GROUP BY node)
SELECT n.doc_id, n.n AS n_shingles, coalesce(comp, n.doc_id) AS component_id, coalesce(c.rep, n.doc_id) AS class_id, coalesce(c.copies - 1, 0) + coalesce(w.w, 0) AS n_links
FROM n LEFT JOIN c ON n.h = c.h AND n.n > 0 LEFT JOIN m ON m.node = c.rep LEFT JOIN w ON w.rep = c.rep
"""

ORACLES = {"op1_substring_dedup": OP1_SQL, "op4_warc": OP4_SQL, "op5_secret_scan": OP5_SQL, "op6_jaccard_join": OP6_SQL, "op7_exact_search": OP7_SQL, "op11_conversation_repair": OP11_SQL, "op12_resampling": OP12_SQL, "op13_chat_format": OP13_SQL}
