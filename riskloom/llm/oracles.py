"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from riskloom.llm.secret_scan import KINDS, PLACEHOLDER

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_kind(rank: int) -> str:
    kind = KINDS[rank]
    pattern = _quoted(kind.pattern)
    needs = "".join(f" AND regexp_matches(v, {_quoted(n)})" for n in kind.needs)
    return f"""
    SELECT r, doc_id, owner, {rank} AS rank, '{kind.name}' AS kind, {kind.base} AS base, v,
           list_sum(list_transform(p[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start, length(m[i]) AS n
    FROM (SELECT r, doc_id, owner, p, m, i, g[i] AS v
          FROM (SELECT r, doc_id, owner, regexp_split_to_array(text, {pattern}) AS p,
                       regexp_extract_all(text, {pattern}, 0) AS m,
                       regexp_extract_all(text, {pattern}, {kind.group}) AS g FROM d),
               unnest(range(1, len(m) + 1)) AS u(i))
    WHERE length(v) >= {kind.least}{needs}"""


SECRETS = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text
    FROM documents),
spans AS ({" UNION ALL ".join(_secret_kind(i) for i in range(len(KINDS)))}),
owners AS (SELECT v, count(DISTINCT owner) AS n_owners FROM spans GROUP BY v),
judged AS (
    SELECT s.*, CASE WHEN n_owners >= 3 THEN 'copied'
        WHEN NOT regexp_matches(v, {_quoted(PLACEHOLDER)}) AND len(list_distinct(string_split(v, ''))) >= 8
        THEN 'live' ELSE 'placeholder' END AS class
    FROM spans s JOIN owners USING (v)),
per AS (
    SELECT r,
        count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, rank) FILTER (base) AS b,
        string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, rank) AS spans,
        count(*) FILTER (class = 'live') AS n_live, count(*) FILTER (class = 'copied') AS n_copied
    FROM judged WHERE base OR class = 'live' GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
    coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per USING (r)
"""

_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
CONTAMINATION = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
gram AS (
    SELECT DISTINCT item, least(len(w), 13) AS n, w[i:i + least(len(w), 13) - 1] AS g
    FROM item, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS u(i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
hit AS (
    SELECT r, i, gram.n, item
    FROM (SELECT r, w, i, n FROM d, (SELECT DISTINCT n FROM gram), unnest(range(1, len(w) - n + 2)) AS u(i)) x
    JOIN gram ON gram.n = x.n AND gram.g = x.w[x.i:x.i + x.n - 1]),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS u(p) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

_REACH = """
reach(a, b) AS (
    SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
low AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
"""

NEAR_TEXTS = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') || CASE WHEN len(w) < 3 THEN ' ' ELSE '' END AS g
    FROM w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id != y.doc_id
    GROUP BY ALL),
link AS (
    SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * c >= 85 * (na.n + nb.n - c)),
{_REACH}
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(root, doc_id)) AS component_id,
    doc_id <= coalesce(root, doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = doc_id
"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v),
link AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id != y.vec_id AND x.n > 0 AND y.n > 0
    AND len(x.e) = len(y.e) AND list_inner_product(x.e, y.e) / (x.n * y.n) >= 0.9),
{_REACH},
degree AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(root, vec_id)) AS component_id,
    vec_id <= coalesce(root, vec_id) AS kept
FROM embeddings LEFT JOIN degree ON degree.a = vec_id LEFT JOIN low ON low.a = vec_id
"""

# crc32 of the decimal id, one bit a step
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
        string_split(CAST(conv_id AS VARCHAR), ''),
        lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)), CAST(4294967295 AS BIGINT))"""
TRIE = f"""
WITH t AS (
    SELECT conv_id, turn, strlen(coalesce(text, '')) AS n,
        sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS s
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(s || ':' || n ORDER BY turn NULLS FIRST, s) AS p, {_CRC} % 9 AS h FROM t GROUP BY conv_id),
r AS (
    SELECT c.conv_id, list_concat(coalesce(o.p, [])[1:c.h], c.p[c.h + 1:]) AS p
    FROM own c LEFT JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5),
x AS (
    SELECT conv_id, d, p[1:d] AS path, array_to_string(p[1:d], ',') AS k, d = len(p) AS ending
    FROM r, unnest(range(0, len(p) + 1)) AS u(d)),
n AS (
    SELECT k, d, any_value(path) AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ending), '')) AS ends_sha256
    FROM x GROUP BY k, d),
kids AS (SELECT array_to_string(path[1:d - 1], ',') AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
own_values AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * CAST(split_part(path[d], ':', 2) AS BIGINT) END AS saved
    FROM n LEFT JOIN kids USING (k)),
below AS (
    SELECT array_to_string(path[1:e], ',') AS k, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves,
        CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM own_values, unnest(range(0, d + 1)) AS u(e) GROUP BY 1)
SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves, b.saved_tokens,
    v.ends_sha256
FROM own_values v JOIN below b ON b.k = v.k
    LEFT JOIN n up ON up.d = v.d - 1 AND up.k = array_to_string(v.path[1:v.d - 1], ',')
"""

ORACLES = {
    "op13_prefix_trie": TRIE,
    "op1_secret_scan": SECRETS,
    "op5_minhash": NEAR_TEXTS,
    "op7_decontaminate": CONTAMINATION,
    "op9_embedding": NEAR_VECTORS,
}
