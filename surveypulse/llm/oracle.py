"""SQL for the operators that SQL can express, each written from the contract alone."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def substring_sql(window: int = 13) -> str:
    last = window - 1
    return f"""WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + {last}], ' ') AS win FROM w, unnest(range(1, len(ws) - {last - 1})) AS r(i)),
m AS (SELECT win, min(doc_id) AS least FROM g GROUP BY win),
c AS (SELECT DISTINCT g.doc_id, i + j AS p FROM g JOIN m ON g.win = m.win, unnest(range({window})) AS u(j) WHERE least < g.doc_id),
p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.p) FILTER (WHERE c.p IS NULL) AS kept, count(c.p) AS n
      FROM p LEFT JOIN c ON c.doc_id = p.doc_id AND c.p = p.p GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id"""


def near_sql(size: int = 3, similar: int = 85) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = f"translate(coalesce(text, ''), '{upper}', '{upper.lower()}')"
    return f"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {WORDS.format(text=text)} AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {size - 1}], ' ') AS sh
  FROM w, unnest(range(1, greatest(len(ws) - {size - 1}, 1) + 1)) AS r(i) WHERE len(ws) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= {similar} * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS u, doc_id AS v FROM w UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY u)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, component_id = w.doc_id AS kept
FROM w JOIN c ON c.u = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id"""
