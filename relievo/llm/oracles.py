"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
h AS (SELECT doc_id, g FROM s WHERE g IN (SELECT g FROM s GROUP BY g HAVING count(*) > 1)),
i AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM h a JOIN h b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 80 * (p.c + q.c - o)
), r(doc_id, y) AS (
  SELECT x, y FROM l UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.y
)
SELECT d.doc_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(y) AS y FROM r GROUP BY 1) m USING (doc_id)
"""

_OP6 = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (SELECT payload_digest, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest AND p.payload_bytes >= 1000
"""

_OP8 = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, role, text FROM conversations
), c AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY k) AS turns FROM t GROUP BY 1
), g AS (SELECT min(conv_id) AS conv_id, turns, count(*) AS n_copies FROM c GROUP BY turns),
x AS (SELECT DISTINCT turns[1:i] AS head FROM (SELECT turns, unnest(range(1, len(turns))) AS i FROM g))
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns, n_copies,
  array_to_string(list_transform(turns, lambda z: '<|' || coalesce(z.r, '') || '|>' || chr(10) || coalesce(z.t, '') || '<|end|>' || chr(10)), '') AS text
FROM g WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.head = g.turns)
"""

#: The checksum of a number's decimal digits, bit by bit, as SQL has no function for it.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
    lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

_OP11 = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, list({{'r': role, 'x': text}} ORDER BY k) AS turns, {_CRC} % 9 AS h FROM t GROUP BY conv_id
), c AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], o.turns[1:0]), o.turns[o.h + 1:]) AS turns
  FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 5
), p AS (SELECT conv_id, d, turns[1:d] AS node, len(turns) = d AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM c)),
g AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM p GROUP BY node
), k AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1),
n AS (SELECT g.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(strlen(g.node[depth].x), 0) AS saved FROM g LEFT JOIN k ON k.node = g.node),
s AS (
  SELECT node[1:d] AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM n) GROUP BY 1
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN n u ON n.depth > 0 AND u.node = n.node[1:n.depth - 1]
"""


def _op9() -> str:
    from relievo.llm.secrets import BASE, COMPLETES, KINDS, LEAST_ASSIGNED, PATTERNS, SCOPE

    quoted = lambda s: s.replace("'", "''")
    kinds = []
    for i, kind in enumerate(KINDS):
        pattern = quoted(PATTERNS[kind])
        value = f"regexp_extract_all(x, '{pattern}', {2 if kind == 'assign' else 0})"
        fits = f"length(v) >= {LEAST_ASSIGNED}" if kind == "assign" else "length(v) = 40" if kind == "weak_secret" else "true"
        kinds.append(
            f"SELECT doc_id, {i} AS kind, unnest(regexp_extract_all(x, '{pattern}', 0)) AS m, unnest({value}) AS v, "
            f"unnest(regexp_split_to_array(x, '{pattern}')[1:len(regexp_extract_all(x, '{pattern}', 0))]) AS g, "
            f"generate_subscripts(regexp_extract_all(x, '{pattern}', 0), 1) AS i FROM d WHERE regexp_matches(x, '{pattern}')"
        )
        kinds[-1] = f"SELECT doc_id, kind, i, length(m) AS l, length(g) AS gap, {fits} AS ok FROM ({kinds[-1]})"
    near = " OR ".join(
        f"(w.kind = {KINDS.index(k)} AND EXISTS (SELECT 1 FROM u WHERE u.doc_id = w.doc_id AND abs(u.s - w.s) <= {SCOPE} AND u.kind IN ({', '.join(str(KINDS.index(o)) for o in others)})))"
        for k, others in COMPLETES.items()
    )
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "][kind + 1]"
    at = f"{names} || ':' || s || ':' || e"
    counts = ", ".join(f"CAST(coalesce(count(*) FILTER (WHERE kind = {i}), 0) AS BIGINT) AS n_{k}" for i, k in enumerate(BASE))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
a AS ({' UNION ALL '.join(kinds)}),
p AS (SELECT doc_id, kind, ok, sum(gap + l) OVER (PARTITION BY doc_id, kind ORDER BY i) AS e, l FROM a),
f AS (SELECT doc_id, kind, CAST(e - l AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM p WHERE ok),
b AS (SELECT * FROM f WHERE kind < {len(BASE)}),
w AS (SELECT * FROM f WHERE kind >= {len(BASE)} AND NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = f.doc_id AND b.s < f.e AND f.s < b.e)),
u AS (SELECT * FROM b UNION ALL SELECT * FROM w),
k AS (SELECT * FROM b UNION ALL SELECT w.* FROM w WHERE {near}),
o AS (SELECT doc_id, {counts}, string_agg({at}, ',' ORDER BY s, kind) FILTER (WHERE kind < {len(BASE)}) AS base,
  string_agg({at}, ',' ORDER BY s, kind) AS spans FROM k GROUP BY 1)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (doc_id)
"""


ORACLES = {"op3_ngram_jaccard_join": _OP3, "op6_warc": _OP6, "op8_chat_formatting": _OP8, "op9_secret_scans": _op9(), "op11_prefix_trie": _OP11}
