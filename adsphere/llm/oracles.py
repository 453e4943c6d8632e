"""DuckDB SQL for the corpus queries that SQL can say, over the whole tables."""

from __future__ import annotations

#: crc32 of the decimal doc_id: eight shift-and-xor steps per byte, one byte per recursion.
CRC = """
crc_steps(doc_id, rest, c) AS (
    SELECT DISTINCT doc_id, doc_id::VARCHAR, 4294967295::UBIGINT FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT doc_id, rest[2:], list_reduce(
        list_prepend(xor(c, ascii(rest)::UBIGINT), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))
    FROM crc_steps WHERE rest <> ''
),
crcs AS (SELECT doc_id, xor(c, 4294967295::UBIGINT) AS crc FROM crc_steps WHERE rest = '')"""


def _leaf(n_chars: str) -> str:
    fields = ("d.doc_id", "d.source", "d.lang", n_chars, "d.text")
    return "sha256(" + " || ".join(
        f"coalesce(strlen(({f})::VARCHAR)::VARCHAR || ':' || ({f})::VARCHAR, '-')" for f in fields) + ")"


OP12 = f"""
WITH RECURSIVE {CRC},
leaves AS (
    SELECT d.doc_id, d.lang, {_leaf('d.n_chars')} AS leaf,
           CASE WHEN crc % 7 = 0 THEN {_leaf('d.n_chars::HUGEINT + 1')} END AS changed
    FROM documents d LEFT JOIN crcs USING (doc_id)
),
named AS (SELECT *, coalesce('=' || lang, '') AS tree FROM leaves),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           row_number() OVER () AS id FROM named
),
low(tree, lvl, place, h, n) AS (
    SELECT tree, 0, place, leaf, count(*) OVER (PARTITION BY tree) FROM placed
    UNION ALL
    SELECT tree, any_value(lvl) + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 1) // 2
    FROM low WHERE n > 1 GROUP BY tree, place // 2
),
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM low WHERE n = 1),
top(lvl, place, h, n) AS (
    SELECT 0, place, subroot, count(*) OVER () FROM subroots
    UNION ALL
    SELECT any_value(lvl) + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 1) // 2
    FROM top WHERE n > 1 GROUP BY place // 2
),
root AS (SELECT h AS root FROM top WHERE n = 1),
-- a row for each level below the tree's root, then for each below the root; h is NULL for a node without sibling
steps AS (
    SELECT p.id, l.lvl AS step, (p.place >> l.lvl) % 2 AS odd, s.h
    FROM placed p JOIN (SELECT DISTINCT tree, lvl FROM low WHERE n > 1) l USING (tree)
    LEFT JOIN low s ON s.tree = p.tree AND s.lvl = l.lvl AND s.place = xor(p.place >> l.lvl, 1::BIGINT)
    UNION ALL
    SELECT p.id, 1000 + l.lvl, (r.place >> l.lvl) % 2, s.h
    FROM placed p JOIN subroots r USING (tree) JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) l ON true
    LEFT JOIN top s ON s.lvl = l.lvl AND s.place = xor(r.place >> l.lvl, 1::BIGINT)
),
way AS (
    SELECT id, list({{'odd': odd, 'h': h}} ORDER BY step) AS way, coalesce(string_agg(h, '' ORDER BY step), '') AS siblings
    FROM steps GROUP BY id
),
fold(id, k, h) AS (
    SELECT id, 1, coalesce(changed, leaf) FROM placed
    UNION ALL
    SELECT f.id, k + 1, sha256(CASE WHEN way[k].odd = 1 THEN coalesce(way[k].h, '') || f.h
                                    ELSE f.h || coalesce(way[k].h, '') END)
    FROM fold f JOIN way USING (id) WHERE k <= len(way)
),
folded AS (SELECT id, arg_max(h, k) AS folded_root FROM fold GROUP BY id)
SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(coalesce(w.siblings, '')) AS proof_sha256, f.folded_root,
       f.folded_root = r.root AS verified
FROM placed p JOIN subroots s USING (tree) JOIN folded f USING (id) LEFT JOIN way w USING (id) CROSS JOIN root r
"""

OP11 = """
WITH items AS (
    SELECT row_number() OVER () AS id, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.id AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM items a JOIN items b ON a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS o
    FROM scores WHERE same AND vec_id <> anchor_id QUALIFY o <= 5
),
ranked AS (
    SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.o ORDER BY s.score DESC, s.vec_id) AS r
    FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
     AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE r <= 10
"""

ORACLES: dict[str, str] = {"op11_hard_negatives": OP11, "op12_merkle": OP12}
