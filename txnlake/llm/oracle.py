"""DuckDB SQL for the corpus queries whose results are exact and which SQL can state."""

from __future__ import annotations

#: CRC-32 of a text of ASCII characters, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ord(s[i])::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


def _kept(scale: int, width: int | None = None) -> str:
    """vec_id and integer components of the vectors that take part; n tells repeated rows apart."""
    sized = f"AND len(embedding) = {width}" if width else ""
    return f"""SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL {sized} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


_PRODUCT = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))"
_DISTANCE = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

MAXSCORE = f"""WITH k AS MATERIALIZED ({_kept(256)}), s AS (SELECT a.vec_id AS query_id, b.vec_id, coalesce({_PRODUCT}, 0)::BIGINT AS score FROM k a JOIN k b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

WARC = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages), b AS (SELECT *, octet_length(body) AS n FROM p),
  d AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS best FROM b)
  SELECT page_id, n::BIGINT AS payload_bytes, sha1(body) AS payload_digest, CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN best <> page_id THEN best END AS refers_to FROM d"""

TRIE = f"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
  g AS (SELECT *, md5(strlen(role)::VARCHAR || ':' || role || text) AS k FROM t),
  l AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(strlen(text) ORDER BY turn NULLS FIRST, k) AS bs, conv_id::VARCHAR AS s FROM g GROUP BY conv_id),
  h AS (SELECT *, {_CRC32} % 9 AS h FROM l),
  r AS MATERIALIZED (SELECT o.conv_id, list_concat(coalesce(b.ks[1:o.h], []), o.ks[o.h + 1:]) AS ks, list_concat(coalesce(b.bs[1:o.h], []), o.bs[o.h + 1:]) AS bs FROM h o LEFT JOIN h b ON b.conv_id = o.conv_id - ((o.conv_id % 5) + 5) % 5),
  n AS MATERIALIZED (SELECT ks[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n, CASE WHEN d = 0 THEN 0 ELSE min(bs[d]) END AS b FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM r) GROUP BY ks[1:d], d),
  c AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
  f AS MATERIALIZED (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM n LEFT JOIN c ON n.p = c.p),
  u AS (SELECT p[1:e] AS p, sum((n - 1) * b) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM f) GROUP BY 1),
  e AS (SELECT ks AS p, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha FROM r GROUP BY 1)
  SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, u.leaves AS n_leaves, u.saved::BIGINT AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
  FROM f JOIN u ON f.p = u.p LEFT JOIN e ON f.p = e.p LEFT JOIN f q ON f.d > 0 AND q.d = f.d - 1 AND q.p = f.p[1:f.d - 1]"""


def _centroids(k: int = 8, rounds: int = 10, seed: int = 3) -> str:
    parts = [f"k AS MATERIALIZED ({_kept(1024, 64)})", f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR), v) - 1 AS j, v FROM k QUALIFY j < {k})"]
    for r in range(rounds + 1):
        # the distance and the centroid's number in one integer, so that the least has both
        parts.append(f"a{r} AS MATERIALIZED (SELECT a.n, min({_DISTANCE} * {k} + b.j)::BIGINT AS m FROM k a CROSS JOIN c{r} b GROUP BY a.n)")
        if r < rounds:
            sums = f"SELECT j, p, sum(x) AS s, count(*) AS n FROM (SELECT m % {k} AS j, generate_subscripts(v, 1) AS p, unnest(v) AS x FROM a{r} JOIN k USING (n)) GROUP BY j, p"
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(w.v, c.v) AS v FROM c{r} c LEFT JOIN (SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY p) AS v FROM ({sums}) GROUP BY j) w ON c.j = w.j)")
    return f"""WITH {", ".join(parts)}, d AS (SELECT vec_id, m % {k} AS j, m // {k} AS distance FROM a{rounds} JOIN k USING (n))
  SELECT vec_id, d.j::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY d.j)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM d JOIN c{rounds} c ON d.j = c.j"""


ORACLE_SQL: dict[str, str] = {"op6_warc_dictionary": WARC, "op10_maxscore": MAXSCORE, "op11_prefix_trie": TRIE, "op13_float32_centroids": _centroids()}
