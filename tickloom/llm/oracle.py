"""SQL for DuckDB, for the operators whose results it can express: by brute force."""

from __future__ import annotations

JACCARD = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
         END AS g
  FROM d),
x AS (SELECT doc_id, unnest(g) AS t FROM s),
n AS (SELECT doc_id, len(g) AS n FROM s),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * i >= 85 * (na.n + nb.n - i)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reached(a, b) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT r.a, w.b FROM reached r JOIN both_ways w ON r.b = w.a)
SELECT n.doc_id, n.n AS n_shingles, m.component_id
FROM n JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) m ON m.a = n.doc_id"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (
         PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5"""

_ASSIGN = """
a{n} AS (
  SELECT vec_id, row, v, arg_min(number, (d, number)) AS number, min(d) AS d
  FROM (SELECT v.*, c.number, CAST(list_sum(list_transform(list_zip(v.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM v CROSS JOIN c{n} c)
  GROUP BY vec_id, row, v)"""

_MOVE = """
s{m} AS (
  SELECT number, j, sum(x) AS s, count(*) AS n
  FROM (SELECT number, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{n}) GROUP BY number, j),
c{m} AS (
  SELECT c.number, coalesce(m.c, c.c) AS c
  FROM c{n} c LEFT JOIN (
    SELECT number, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM s{m} GROUP BY number) m
  ON m.number = c.number)"""

CENTROIDS = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INTEGER) AS number, v AS c
  FROM v QUALIFY number < 16),""" + ",".join(
    [_ASSIGN.format(n=n) + "," + _MOVE.format(n=n, m=n + 1) for n in range(3)] + [_ASSIGN.format(n=3)]
) + """
SELECT vec_id, a3.number AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a3.number) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c3.c, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.number = a3.number"""


def all_oracles() -> dict[str, str]:
    return {"op1_jaccard": JACCARD, "op9_top_k": TOP_K, "op13_centroids": CENTROIDS}
