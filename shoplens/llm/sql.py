"""DuckDB SQL of the queries that SQL can express, written from their definitions."""

OP1 = """
WITH d AS (SELECT doc_id, source, length(coalesce(text, '')) AS size, length(text) AS text_chars FROM documents),
s AS (SELECT source, sum(size) AS size FROM d GROUP BY source),
r AS (
    SELECT source, CASE WHEN size > 0
        THEN (SELECT sum(size) FROM s) * sqrt(size) / (SELECT sum(sqrt(size)) FROM s) / size ELSE 0 END AS rate
    FROM s
),
m AS (SELECT ceil(max(rate) + 14 * sqrt(max(rate)) + 40)::BIGINT AS most FROM r),
k AS (SELECT unnest(range(0, most))::BIGINT AS k FROM m),
c AS (
    SELECT source, k, sum(CASE WHEN rate > 0 THEN exp(-rate + k * ln(rate) - lgamma(k + 1)) WHEN k = 0 THEN 1 ELSE 0 END)
        OVER (PARTITION BY source ORDER BY k) AS below
    FROM r CROSS JOIN k
),
u AS (
    SELECT rowid_ AS id, doc_id, source, text_chars,
        ((('0x' || substr(md5('17|' || doc_id), 1, 13))::BIGINT) + 0.5) / 4503599627370496.0 AS unit
    FROM (SELECT *, row_number() OVER () AS rowid_ FROM d)
),
n AS (
    SELECT id, any_value(doc_id) AS doc_id, any_value(u.source) AS source, any_value(text_chars) AS text_chars, count(*) AS copies
    FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.below < u.unit
    GROUP BY id
)
SELECT doc_id, source, copy::INTEGER AS copy, text_chars::INTEGER AS text_chars,
    md5('17-order|' || doc_id || '|' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM n)
"""

OP4 = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
o AS (
    SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
        sum(24 + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;'))
            + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'))) OVER w AS prefix
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(prefix) FILTER (role = 'assistant' OR pos = n))::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

OP5 = """
WITH l AS (
    SELECT id, doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (
        SELECT id, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
        FROM (SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
    )
),
k AS (
    SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
m AS (SELECT l.*, k.keeper IS NOT NULL AND k.keeper <> l.doc_id AS gone FROM l LEFT JOIN k ON l.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY id
"""

OP7 = """
WITH d AS (
    SELECT row_number() OVER () AS id, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
s AS (SELECT id, unnest(range(1, len(w) - 33)) AS pos, w FROM d WHERE len(w) >= 35),
h AS (SELECT id, pos, array_to_string(w[pos:pos + 34], ' ') AS run FROM s),
r AS (SELECT id, pos FROM (SELECT id, pos, count(*) OVER (PARTITION BY run) AS n FROM h) WHERE n > 1),
t AS (SELECT id, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d WHERE len(w) > 0),
g AS (
    SELECT t.id, t.pos, t.word, coalesce(t.pos - max(r.pos) OVER (PARTITION BY t.id ORDER BY t.pos) < 35, false) AS gone
    FROM t LEFT JOIN r ON t.id = r.id AND t.pos = r.pos
)
SELECT any_value(d.doc_id) AS doc_id, count(g.pos) AS n_words, (count(g.pos) FILTER (g.gone))::BIGINT AS n_removed,
    sha256(coalesce(string_agg(g.word, ' ' ORDER BY g.pos) FILTER (NOT g.gone), '')) AS kept_sha256
FROM d LEFT JOIN g ON d.id = g.id GROUP BY d.id
"""

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_CRC = """(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
    4294967295))"""


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _climb(name: str, nodes: str) -> str:
    """Digests of all levels above ``nodes`` (tree, idx, n, hash)."""
    return f"""{name} AS (
    SELECT tree, 0 AS level, idx, n, hash FROM {nodes}
    UNION ALL
    SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
    FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 2, n
)"""


def _path(name: str, nodes: str, levels: str) -> str:
    """Steps of each node to its root: the side of the sibling (L or R) and its digest, if there is one."""
    return f"""{name} AS (
    SELECT d.tree, d.idx, list(CASE WHEN s.idx % 2 = 0 THEN 'L' ELSE 'R' END || coalesce(s.hash, '') ORDER BY o.level) AS steps
    FROM {nodes} d JOIN {levels} o ON o.tree = d.tree AND o.idx = d.idx >> o.level AND o.n > 1
    LEFT JOIN {levels} s ON s.tree = d.tree AND s.level = o.level AND s.idx = xor(o.idx, 1)
    GROUP BY d.tree, d.idx
)"""


OP11 = f"""
WITH RECURSIVE a AS (
    SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
        CASE WHEN coalesce({_CRC} % 7 = 0, false) THEN {_leaf('(n_chars::HUGEINT + 1)')} ELSE {_leaf('n_chars')} END AS tampered
    FROM documents
),
d AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, leaf AS hash,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
    FROM a
),
{_climb("lv", "d")},
t AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, hash FROM lv WHERE n = 1),
{_climb("tv", "t")},
{_path("low", "d", "lv")},
{_path("high", "t", "tv")},
r AS (
    SELECT d.doc_id, d.leaf, d.tampered, t.hash AS subroot, (SELECT hash FROM tv WHERE n = 1) AS root,
        list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
    FROM d JOIN t ON t.idx = d.tree LEFT JOIN low ON low.tree = d.tree AND low.idx = d.idx LEFT JOIN high ON high.idx = d.tree
),
f AS (
    SELECT *, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
        list_reduce(list_prepend(tampered, steps), lambda h, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root
    FROM r
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f
"""

OP12 = """
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
s AS (
    SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
    FROM d
),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.id <> b.id GROUP BY a.id, b.id),
e AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r AS (SELECT id AS start, id AS at FROM d UNION SELECT r.start, e.b FROM r JOIN e ON e.a = r.at),
c AS (SELECT start, min(d.doc_id) AS component_id FROM r JOIN d ON d.id = r.at GROUP BY start)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c ON c.start = d.id LEFT JOIN n ON n.id = d.id
"""

OP13 = """
WITH v AS (
    SELECT row_number() OVER () AS id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT a.id AS anchor, a.vec_id AS anchor_id, b.id AS other, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.id <> b.id WHERE a.vec_id % 50 = 0
),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.vec_id) AS r
    FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 3
"""

SQL = {"op7_substring_dedup": OP7, "op1_mixing": OP1, "op4_chat": OP4, "op5_line_dedup": OP5, "op11_merkle": OP11, "op12_set_sketch": OP12, "op13_hard_negatives": OP13}
