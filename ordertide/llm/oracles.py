"""SQL for the queries whose whole result SQL can express."""

from __future__ import annotations

from ordertide.llm import centroids


def _centroids() -> str:
    """Three rounds and the last assignment, in rows of (vector, component) and (centroid, component)."""
    parts = [f"""kept AS (
  SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE len(embedding) = {centroids.DIMENSIONS}
    AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {centroids.DIMENSIONS}
), v AS (
  SELECT row, vec_id, unnest(range({centroids.DIMENSIONS})) AS i,
         CAST(floor({centroids.SCALE} * unnest(x)) AS BIGINT) AS e FROM kept
), chosen AS (
  SELECT row, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id)) - 1 AS c FROM kept
), c0 AS (
  SELECT chosen.c, v.i, v.e FROM chosen JOIN v USING (row) WHERE chosen.c < {centroids.CLUSTERS}
)"""]
    for k in range(centroids.ROUNDS + 1):
        parts.append(f"""d{k} AS (
  SELECT v.row, c.c, CAST(sum((v.e - c.e) * (v.e - c.e)) AS BIGINT) AS d FROM v JOIN c{k} c USING (i) GROUP BY v.row, c.c
), a{k} AS (
  SELECT row, c, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1
)""")
        if k < centroids.ROUNDS:
            parts.append(f"""c{k + 1} AS (
  SELECT c, i, coalesce(m, e) AS e FROM c{k} LEFT JOIN (
    SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
    FROM (SELECT a.c, v.i, sum(v.e) AS s, count(*) AS n FROM a{k} a JOIN v USING (row) GROUP BY a.c, v.i)
  ) USING (c, i)
)""")
    last = centroids.ROUNDS
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, g.centroid_sha256
FROM a{last} a JOIN kept USING (row)
JOIN (SELECT c, sha256(string_agg(CAST(e AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY c) g
  ON g.c = a.c"""


ORACLES: dict[str, str] = {"op13_centroid_expressions": _centroids()}
