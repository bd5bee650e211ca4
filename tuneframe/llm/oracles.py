"""DuckDB SQL for the queries that it can express."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array({text}, '[ \t-\r]+'), lambda x: x <> '')"


def repeated_windows(width: int, removed: str, spans: str) -> str:
    """Words in windows of `width` words that occur twice anywhere, and what is left of each text."""
    return f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
i AS (SELECT rid, words, unnest(range(len(words) - {width - 1})) AS p FROM w WHERE len(words) >= {width}),
g AS (SELECT rid, p, array_to_string(list_slice(words, p + 1, p + {width}), ' ') AS k FROM i),
twice AS (SELECT k FROM g GROUP BY k HAVING count(*) > 1),
d AS (SELECT DISTINCT rid, p + o AS spot FROM (SELECT rid, p, unnest(range({width})) AS o FROM g JOIN twice USING (k))),
runs AS (
  SELECT rid, min(spot) AS a, max(spot) + 1 AS b
  FROM (SELECT rid, spot, spot - row_number() OVER (PARTITION BY rid ORDER BY spot) AS island FROM d) GROUP BY rid, island
),
s AS (SELECT rid, string_agg(a || ':' || b, ',' ORDER BY a) AS spans, sum(b - a) AS n FROM runs GROUP BY rid),
each_word AS (SELECT rid, unnest(words) AS word, unnest(range(len(words))) AS spot FROM w),
kept AS (
  SELECT e.rid, string_agg(word, ' ' ORDER BY e.spot) AS words
  FROM each_word e LEFT JOIN d ON d.rid = e.rid AND d.spot = e.spot WHERE d.spot IS NULL GROUP BY e.rid
)
SELECT doc_id, len(w.words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS {removed},
  sha256(coalesce(kept.words, '')) AS kept_sha256, coalesce(spans, '') AS {spans}
FROM w LEFT JOIN s USING (rid) LEFT JOIN kept USING (rid)
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS.format(text=_LOWER)} AS words FROM documents),
e AS (
  SELECT rid, unnest(list_distinct(CASE
    WHEN len(words) >= 3 THEN list_transform(range(len(words) - 2), lambda i: words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3])
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END)) AS s
  FROM w
),
n AS (SELECT rid, count(*) AS n FROM e GROUP BY rid),
pairs AS (SELECT a.rid AS a, b.rid AS b, count(*) AS inter FROM e a JOIN e b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
half AS (SELECT a, b FROM pairs JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * inter >= 90 * (x.n + y.n - inter)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(a, b) AS (SELECT rid, rid FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT r.a AS rid, min(w.doc_id) AS component_id FROM reach r JOIN w ON w.rid = r.b GROUP BY r.a),
degree AS (SELECT a AS rid, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM w JOIN least USING (rid) LEFT JOIN n USING (rid) LEFT JOIN degree USING (rid)
"""


_BITS = ", ".join(["-1"] * 8)
_CRC32 = f"""xor(list_reduce([4294967295] || flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ord(x), {_BITS}])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""

TRIE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, left(sha256(strlen(role) || ':' || role || text), 32) AS code, len({WORDS.format(text="text")}) AS n FROM t),
c AS (SELECT conv_id, list({{'code': code, 'n': n}} ORDER BY turn NULLS FIRST, code) AS ts FROM k GROUP BY conv_id),
h AS (SELECT *, {_CRC32} % 4 AS h FROM c),
b AS (
  SELECT a.conv_id, list_concat(coalesce(list_slice(o.ts, 1, a.h), []), list_slice(a.ts, a.h + 1, len(a.ts))) AS ts
  FROM h a LEFT JOIN c o ON o.conv_id = a.conv_id - a.conv_id % 20
),
e AS (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM b),
p AS (
  SELECT conv_id, d, array_to_string(list_transform(list_slice(ts, 1, d), lambda x: x.code), '') AS path,
    CASE WHEN d > 0 THEN ts[d].n ELSE 0 END AS n, d = len(ts) AS ended
  FROM e
),
g AS (
  SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM p GROUP BY path
),
kids AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n FROM g WHERE depth > 0 GROUP BY 1),
v AS (SELECT g.path, g.saved, g.depth, kids.n IS NULL AS leaf FROM g LEFT JOIN kids USING (path)),
up AS (SELECT left(path, 32 * a) AS path, saved, leaf FROM (SELECT path, saved, leaf, unnest(range(depth + 1)) AS a FROM v)),
sums AS (SELECT path, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves FROM up GROUP BY path)
SELECT g.conv_id, g.depth::BIGINT AS depth, o.conv_id AS parent_conv_id, g.n_convs::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
  sums.leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, g.ends_sha256
FROM g JOIN sums USING (path) LEFT JOIN kids USING (path) LEFT JOIN g o ON g.depth > 0 AND o.path = left(g.path, 32 * (g.depth - 1))
"""
