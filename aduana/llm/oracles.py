"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from aduana.llm.sharding import N_SHARDS, TABLE_SIZE

_SPACES = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM lines),
crowded AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.line, k.pos, c.keeper IS NOT NULL AND c.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN crowded c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Shingles as text, all pairs that share one, and the closure of the links.
OP3 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM sets
"""

# The shards take turns, one claim per step: `free` marks the slots left, `at` where each shard's search stands.
OP4 = f"""
WITH RECURSIVE shards AS (
  SELECT s, ('0x' || substr(md5('start:' || s), 1, 15))::BIGINT % {TABLE_SIZE} AS start,
         ('0x' || substr(md5('step:' || s), 1, 15))::BIGINT % {TABLE_SIZE - 1} + 1 AS step
  FROM range({N_SHARDS}) t(s)),
orders AS (
  SELECT s, list_transform(range({TABLE_SIZE}), lambda j: (start + j * step) % {TABLE_SIZE}) AS slots FROM shards),
fill(turn, slot, free) AS (
  SELECT CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), list_transform(range({TABLE_SIZE}), lambda j: true)
  UNION ALL
  SELECT turn + 1, chosen, list_concat(list_concat(free[1:chosen], [false]), free[chosen + 2:]) FROM (
    SELECT f.turn, f.free, list_filter(o.slots, lambda x: f.free[x + 1])[1] AS chosen
    FROM fill f JOIN orders o ON o.s = (f.turn + 1) % {N_SHARDS} WHERE f.turn + 1 < {TABLE_SIZE})),
lookup AS (SELECT slot, turn % {N_SHARDS} AS shard_id FROM fill WHERE turn >= 0),
placed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {TABLE_SIZE} AS slot
  FROM documents)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, CAST(shard_id AS INTEGER) AS shard_id FROM placed JOIN lookup USING (slot)
"""

# Windows of 13 words as text, and the first document of each.
OP11 = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM words)),
firsts AS (SELECT x, min(doc_id) AS first FROM windows GROUP BY x),
lost AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM windows JOIN firsts USING (x), range(13) r(k) WHERE first < doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
  FROM placed ANTI JOIN lost USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

# Counts of every kept term in every group, the zeros included.
OP12 = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS found
  FROM documents),
terms AS (SELECT r, lang, source, {_LOWER.format("unnest(found)")} AS term FROM texts),
kept AS (SELECT lang, term FROM terms GROUP BY ALL HAVING count(DISTINCT r) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM texts) g JOIN kept k USING (lang) LEFT JOIN counted USING (lang, source, term)),
totals AS (
  SELECT lang, source, term, n, sum(n) OVER (PARTITION BY lang, source) AS total,
         sum(n) OVER (PARTITION BY lang, term) AS all_n, sum(n) OVER (PARTITION BY lang) AS all_total, v
  FROM cells JOIN sizes USING (lang)),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (all_n + 2)) // (all_total + 2 * v) AS q
  FROM totals),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM texts),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM listed QUALIFY part = 'pair' OR rank <= 10
"""


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


# Nodes by level, the siblings of each document by level, and the fold of its leaf with them. `crc` is the table of CRC-32.
OP13 = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM range(256) r(b)),
hashed AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS sum,
         {_leaf("replace(text, chr(10), '')")} AS bare
  FROM documents, crc),
leaves AS (
  SELECT doc_id, source, leaf, CASE WHEN sum % 2 = 0 THEN bare ELSE leaf END AS given,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place
  FROM hashed),
tree(source, level, place, h, more) AS (
  SELECT source, 0, place, leaf, count(*) OVER (PARTITION BY source) > 1 FROM leaves
  UNION ALL
  SELECT *, count(*) OVER (PARTITION BY source) > 1 FROM (
    SELECT source, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)) FROM tree WHERE more
    GROUP BY source, level, place // 3)),
subroots AS (
  SELECT source, h AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM tree WHERE NOT more),
top(level, place, h, more) AS (
  SELECT 0, place, subroot, count(*) OVER () > 1 FROM subroots
  UNION ALL
  SELECT *, count(*) OVER () > 1 FROM (
    SELECT level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)) FROM top WHERE more GROUP BY level, place // 3)),
nodes AS (
  SELECT source, level, place, h FROM tree WHERE more
  UNION ALL
  SELECT source, height + level, t.place, h FROM top t, subroots WHERE more),
way(doc_id, source, level, height, place, up, h) AS (
  SELECT doc_id, source, 0, height, l.place, s.place, given FROM leaves l JOIN subroots s USING (source)
  UNION ALL
  SELECT doc_id, source, level + 1, height, CASE WHEN level + 1 = height THEN up ELSE place // 3 END, up, h FROM (
    SELECT w.doc_id, w.source, w.level, w.height, w.place, w.up,
           sha256(string_agg(CASE WHEN n.place = w.place THEN w.h ELSE n.h END, '' ORDER BY n.place)) AS h
    FROM way w JOIN nodes n ON w.source = n.source AND w.level = n.level AND w.place // 3 = n.place // 3 GROUP BY ALL)),
steps AS (
  SELECT w.doc_id, w.source, sha256(coalesce(string_agg(n.h, '' ORDER BY w.level, n.place) FILTER (n.place <> w.place), '')) AS proof_sha256,
         max_by(w.h, w.level) AS folded_root
  FROM way w LEFT JOIN nodes n ON w.source = n.source AND w.level = n.level AND w.place // 3 = n.place // 3
  GROUP BY ALL)
SELECT doc_id, leaf, subroot, h AS root, proof_sha256, folded_root, folded_root = h AS verified
FROM leaves JOIN subroots USING (source) JOIN steps USING (doc_id, source), (SELECT h FROM top WHERE NOT more)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1, "op3_jaccard_join": OP3, "op4_sharding": OP4, "op11_substring_dedup": OP11, "op12_divergence": OP12, "op13_merkle": OP13}
