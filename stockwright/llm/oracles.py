"""SQL for a second engine of the queries whose whole result it can say."""

from stockwright.llm.common import LOWER, UPPER

_PLAIN = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_WORDS = f"regexp_extract_all({_PLAIN}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_TOKENS = f"regexp_extract_all({_PLAIN}, '[^\\x20\\x09-\\x0D]+')"

# Every string of 100 bytes with its first place; removed runs are the unions of the later ones.
SUBSTRINGS = """
WITH raw AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes
  FROM documents
), strings AS (
  SELECT doc_id, i, substr(h, 2 * i - 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(1, n_bytes - 98)) AS i FROM raw WHERE n_bytes >= 100)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM strings) WHERE k > 1
), marked AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prior FROM later
), numbered AS (
  SELECT doc_id, i, sum(CASE WHEN prior IS NULL OR i > prior + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i)
    AS run FROM marked
), runs AS (
  SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run
), edges AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS a, a AS b FROM runs
  UNION ALL SELECT doc_id, max(b), 1000000000 FROM runs GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, CAST(2 * a - 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS k
  FROM edges JOIN raw USING (doc_id) GROUP BY doc_id
), gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM raw LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

# Windows of items joined to the windows of documents of the same size.
OVERLAPS = f"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark
), wide AS (SELECT item, w, least(10, len(w)) AS n FROM item WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM wide)
), words AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (SELECT p.doc_id, p.n, p.i, x.item FROM places p JOIN windows x ON x.n = p.n AND x.win = p.win),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id
), owner AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM words w LEFT JOIN hit ON hit.doc_id = w.doc_id LEFT JOIN owner ON owner.doc_id = w.doc_id
"""

# All pairs with a common shingle, then everything reachable over the links.
LINKS = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_TOKENS} AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), near AS (
  SELECT x, y FROM links JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * c >= 85 * (s.n + t.n - c)
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT r.node, e.y FROM reach r JOIN (SELECT x, y FROM near UNION ALL SELECT y, x FROM near) e ON e.x = r.other
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) m ON m.node = d.doc_id
"""


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


# Checksum of a number's digits, bit by bit: a byte (not negative) is added, -1 shifts by one bit.
_CRC32 = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""

# Levels of all trees by recursion, siblings of every node, then each leaf's path upwards.
MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf('text')} END AS found
  FROM documents
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), nodes AS (
  SELECT CAST(g AS BIGINT) AS g, 0 AS l, CAST(i AS BIGINT) AS i, CAST(n AS BIGINT) AS n, leaf AS h FROM placed
  UNION ALL
  SELECT g, l + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1
  GROUP BY g, l, i // 8, n
), subroots AS (SELECT g, l AS top, h FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS l, g AS i, count(*) OVER () AS n, h FROM subroots
  UNION ALL
  SELECT l + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY l, i // 8, n
), both_trees AS (
  SELECT g, l, i, n, h FROM nodes UNION ALL SELECT -1, l, i, n, h FROM upper
), sides AS (
  SELECT a.g, a.l, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lft,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rgt
  FROM both_trees a JOIN both_trees b ON a.g = b.g AND a.l = b.l AND a.i // 8 = b.i // 8
  WHERE a.n > 1 GROUP BY a.g, a.l, a.i
), numbered AS (SELECT *, row_number() OVER () AS r FROM placed),
steps AS (
  SELECT r, s.l AS step, s.lft, s.rgt FROM numbered p JOIN sides s
    ON s.g = p.g AND s.i = p.i // CAST(pow(8, s.l) AS BIGINT)
  UNION ALL
  SELECT r, t.top + s.l, s.lft, s.rgt FROM numbered p JOIN subroots t ON t.g = p.g JOIN sides s
    ON s.g = -1 AND s.i = p.g // CAST(pow(8, s.l) AS BIGINT)
), paths AS (
  SELECT r, string_agg(lft || rgt, '' ORDER BY step) AS proof, max(step) + 1 AS len FROM steps GROUP BY r
), fold AS (
  SELECT p.r, 0 AS step, p.found AS h, coalesce(len, 0) AS len FROM numbered p LEFT JOIN paths q ON q.r = p.r
  UNION ALL
  SELECT f.r, f.step + 1, sha256(s.lft || f.h || s.rgt), f.len FROM fold f JOIN steps s ON s.r = f.r AND s.step = f.step
)
SELECT p.doc_id, p.leaf, t.h AS subroot, u.h AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, f.h AS folded_root,
  f.h = u.h AS verified
FROM numbered p JOIN subroots t ON t.g = p.g JOIN (SELECT h FROM upper WHERE n = 1) u ON true
JOIN fold f ON f.r = p.r AND f.step = f.len LEFT JOIN paths q ON q.r = p.r
"""

# Every item's score in every document that holds one of its terms.
RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
total AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM docs),
places AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM docs),
postings AS (SELECT r, doc_id, n, term, count(*) AS tf FROM places GROUP BY r, doc_id, n, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(any_value(n_docs) AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, total GROUP BY term
), items AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS w FROM benchmark),
asked AS (SELECT DISTINCT q, item_id, unnest(w) AS term FROM items),
scored AS (
  SELECT q, item_id, r, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), total GROUP BY q, item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS k FROM scored WHERE score > 0
)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM ranked WHERE k <= 10
"""
