"""DuckDB SQL for the operators whose results it can express: all pairs and all windows, without any index."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

# components of `links` (x, y), both directions, over `nodes` (id): the least id reachable from each
_REACH = """
reach AS (
    SELECT id, id AS other FROM nodes
    UNION SELECT reach.id, links.y FROM reach JOIN links ON reach.other = links.x
),
roots AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

OP3 = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) > 0
),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH.strip()}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE x = id) AS n_links, component_id, id = component_id AS kept
FROM roots"""

OP5 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 2),
                                                          lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
),
elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
    FROM elements a JOIN elements b
    ON a.e = b.e AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY ALL
),
links AS (SELECT x, y FROM shared WHERE 100 * c >= 80 * (na + nb - c)),
nodes AS (SELECT doc_id AS id FROM documents), {_REACH.strip()}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN roots ON doc_id = id"""

OP7 = f"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents
),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
),
repeated AS (
    SELECT doc_id, i FROM windows JOIN (SELECT h, min(doc_id) AS least FROM windows GROUP BY h) USING (h)
    WHERE least < doc_id
),
gone AS (
    SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM repeated)
    GROUP BY doc_id
),
kept AS (
    SELECT doc_id, w, coalesce(gone, []) AS gone FROM words LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256
FROM kept"""


_TOKENS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TOKENS} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {_TOKENS} AS w FROM benchmark),
iw AS (
    SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS x
    FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM (SELECT *, least(len(w), 10) AS n FROM i WHERE len(w) > 0))
),
dw AS (
    SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS x
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
),
hit AS (SELECT r, s, n, item FROM dw JOIN iw USING (n, x)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
listed AS (
    SELECT r, count(item) AS n_items, coalesce(string_agg(item, ',' ORDER BY item), '') AS items
    FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)"""


def _leaf(n_chars: str) -> str:
    """sha256 over the fields of a row, each with its length."""
    fields = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({c})::VARCHAR || ':' || ({c}), '-')" for c in fields) + ")"


_STEP = "CASE WHEN s.digest IS NULL THEN sha256(w.acc) WHEN s.i < w.i THEN sha256(s.digest || w.acc) ELSE sha256(w.acc || s.digest) END"

OP13 = f"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
),
leaves AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("n_chars")} AS leaf,
           CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                                     lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1])), 4294967295) % 7 = 0
                THEN {_leaf("n_chars + 1")} END AS changed
    FROM documents, crc
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
),
nodes AS (
    SELECT tree, 0 AS level, i, n, leaf AS digest FROM ranked
    UNION ALL
    SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1
    GROUP BY tree, level, i // 2, n
),
subroots AS (
    SELECT tree AS lang, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, digest FROM nodes WHERE n = 1
),
tops AS (
    SELECT 0 AS level, i, n, digest FROM subroots
    UNION ALL
    SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 2, n
),
walk AS (
    SELECT tree, i AS own, 0 AS level, i, n, coalesce(changed, leaf) AS acc, '' AS proof FROM ranked
    UNION ALL
    SELECT w.tree, w.own, w.level + 1, w.i // 2, (w.n + 1) // 2, {_STEP}, w.proof || coalesce(s.digest, '')
    FROM walk w LEFT JOIN nodes s ON s.tree = w.tree AND s.level = w.level AND s.i = xor(w.i, 1) WHERE w.n > 1
),
climb AS (
    SELECT tree, own, 0 AS level, r.i, r.n, acc, proof, r.digest AS subroot FROM walk JOIN subroots r ON lang = tree WHERE walk.n = 1
    UNION ALL
    SELECT w.tree, w.own, w.level + 1, w.i // 2, (w.n + 1) // 2, {_STEP}, w.proof || coalesce(s.digest, ''), w.subroot
    FROM climb w LEFT JOIN tops s ON s.level = w.level AND s.i = xor(w.i, 1) WHERE w.n > 1
)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = digest AS verified
FROM ranked JOIN climb ON climb.tree = ranked.tree AND own = ranked.i AND climb.n = 1 JOIN tops ON tops.n = 1"""


def oracle_sql() -> dict[str, str]:
    found = {"op3_pivot_dedup": OP3, "op5_setsketch": OP5, "op7_substring_dedup": OP7, "op12_winnowing": OP12}
    found |= {"op13_merkle_manifest": OP13}
    return {name: text.strip() for name, text in found.items()}
