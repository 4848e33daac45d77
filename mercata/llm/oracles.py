"""DuckDB SQL of the queries of this subpackage that SQL can express, over whole tables.

The SQL is plain: all pairs that share a shingle, all pairs of vectors, patterns matched by the
engine's own regular expressions.  Two of them rest on facts of the small test tables, where they
run: vectors have 64 parts (whose products are added in the order in which numpy adds them, to the
last bit), and no word there discloses an entity, so the spans of ``op5`` are the base spans.
"""

from __future__ import annotations

from mercata.llm import filter_audit, flat_graph

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+')"

SHINGLE_JOIN = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, {_WORDS} AS words FROM documents
), s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles
    FROM w
), each AS (
    SELECT doc_id, unnest(shingles) AS x FROM s
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM pairs JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b
    WHERE 100 * common >= 80 * (len(p.shingles) + len(q.shingles) - common)
), reached(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS low FROM reached GROUP BY a) r ON r.a = doc_id
"""


def _added(parts: str, n: int = 64) -> str:
    """Sum of a list in eight running sums that are then added in pairs."""
    runs = ["(" + " + ".join(f"{parts}[{k + i}]" for i in range(0, n, 8)) + ")" for k in range(1, 9)]
    return f"((({runs[0]} + {runs[1]}) + ({runs[2]} + {runs[3]})) + (({runs[4]} + {runs[5]}) + ({runs[6]} + {runs[7]})))"


NEAREST = f"""
WITH v AS (
    SELECT vec_id, embedding::DOUBLE[] AS x, list_transform(embedding::DOUBLE[], lambda y: y * y) AS squares FROM embeddings
), n AS (
    SELECT vec_id, x, sqrt({_added('squares')}) AS length FROM v
), p AS (
    SELECT q.vec_id AS query_id, c.vec_id, q.length * c.length AS lengths,
        list_transform(generate_series(1, 64), lambda i: q.x[i] * c.x[i]) AS products
    FROM n q JOIN n c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), s AS (
    SELECT query_id, vec_id, {_added('products')} / lengths AS score FROM p
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "TRUE"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "len(list_filter(string_split(hit, '.'), lambda x: length(ltrim(x, '0')) > 3 OR CAST('0' || right(x, 3) AS INTEGER) > 255)) = 0"),
    ("card", r"[0-9]([ -]?[0-9])+",
     "length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(generate_series(1, length(digits)), lambda k: "
     "CASE WHEN k % 2 = 1 THEN CAST(reverse(digits)[k] AS INTEGER) ELSE 2 * CAST(reverse(digits)[k] AS INTEGER) "
     "- CASE WHEN CAST(reverse(digits)[k] AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15"),
)


def _spans() -> str:
    ctes = ["d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"]
    for rank, (kind, pattern, keep) in enumerate(_KINDS):
        ctes.append(f"""{kind}_found AS (
    SELECT doc_id, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS gaps FROM d WHERE regexp_matches(t, '{pattern}')
), {kind}_each AS (
    SELECT doc_id, hits, gaps, unnest(generate_series(1, len(hits))) AS i FROM {kind}_found
), {kind}_placed AS (
    SELECT doc_id, hits[i] AS hit, regexp_replace(hits[i], '[^0-9]', '', 'g') AS digits,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
    FROM {kind}_each
), {kind}_spans AS (
    SELECT doc_id, CAST(start AS BIGINT) AS start, {rank} AS rank, '{kind}:' || CAST(start AS BIGINT) || ':' || CAST(start + length(hit) AS BIGINT) AS span
    FROM {kind}_placed WHERE {keep}
)""")
    every = " UNION ALL ".join(f"SELECT * FROM {k}_spans" for k, _, _ in _KINDS)
    counts = ", ".join(f"count(*) FILTER (rank = {r}) AS n_{k}" for r, (k, _, _) in enumerate(_KINDS))
    ctes.append(f"of AS (SELECT doc_id, {counts}, string_agg(span, ',' ORDER BY start, rank) AS spans FROM ({every}) x GROUP BY doc_id)")
    shown = ", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k, _, _ in _KINDS)
    return "WITH " + ", ".join(ctes) + f" SELECT d.doc_id, {shown}, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN of USING (doc_id)"


SQL = {
    "op5_disclosure_spans": _spans(),
    "op6_learned_partitions": NEAREST,
    "op9_shingle_join": SHINGLE_JOIN,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_flat_graph": flat_graph.ORACLE,
}
