"""DuckDB SQL for the queries of the text operators that SQL can express."""

from __future__ import annotations


def _leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    texts = (f"coalesce(octet_length(encode(({f})::varchar))::varchar || ':' || ({f})::varchar, '-')" for f in fields)
    return f"sha256({' || '.join(texts)})"


def _tree(name: str, key: str, leaves: str) -> str:
    """All nodes of all trees: level, number on the level, nodes of the level, digest."""
    return f"""
{name}({key}, level, r, n, h) AS (
  SELECT {key}, 0, r, n, h FROM {leaves}
  UNION ALL
  SELECT {key}, level + 1, r // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY r))
  FROM {name} WHERE n > 1 GROUP BY {key}, level, n, r // 2)"""


def _ways(tree: str, key: str, leaves: str) -> str:
    """For each leaf its steps: B or A (the digest stands before or after) or S (no neighbour), and it."""
    return f"""
SELECT l.{key}, l.r, coalesce(list(CASE WHEN s.h IS NULL THEN 'S' WHEN s.r % 2 = 0 THEN 'B' || s.h ELSE 'A' || s.h END ORDER BY o.level)
         FILTER (WHERE o.level IS NOT NULL), []::varchar[]) AS steps
FROM {leaves} l
LEFT JOIN {tree} o ON o.{key} IS NOT DISTINCT FROM l.{key} AND o.n > 1 AND o.r = l.r // (1::bigint << o.level)
LEFT JOIN {tree} s ON s.{key} IS NOT DISTINCT FROM o.{key} AND s.level = o.level AND s.r = xor(o.r, 1)
GROUP BY l.{key}, l.r"""


OP12_MERKLE_MANIFEST = f"""
WITH RECURSIVE crc_steps(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS v FROM crc_steps WHERE k = 8),
hashed AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS h, {_leaf("n_chars + 1")} AS changed,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(doc_id::varchar) + 1), lambda i: ord(substr(doc_id::varchar, i, 1))::bigint)),
        lambda c, b: xor(c >> 8, v[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS tampered
  FROM documents, crc_table),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
{_tree("nodes", "lang", "leaves").strip()},
subroots AS (
  SELECT 0 AS top, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_tree("tops", "top", "subroots").strip()},
ways AS ({_ways("nodes", "lang", "leaves")}),
top_ways AS ({_ways("tops", "top", "subroots")}),
proved AS (
  SELECT l.doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, list_concat(w.steps, u.steps) AS steps,
    CASE WHEN l.tampered THEN l.changed ELSE l.h END AS start
  FROM leaves l JOIN ways w ON w.lang IS NOT DISTINCT FROM l.lang AND w.r = l.r
  JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  JOIN top_ways u ON u.r = s.r JOIN tops t ON t.n = 1),
folded AS (
  SELECT *, sha256(array_to_string(list_transform(steps, lambda x: substr(x, 2)), '')) AS proof_sha256,
    list_reduce(list_prepend(start, steps), lambda acc, x: sha256(CASE substr(x, 1, 1) WHEN 'B' THEN substr(x, 2) || acc WHEN 'A' THEN acc || substr(x, 2) ELSE acc END)) AS folded_root
  FROM proved)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
