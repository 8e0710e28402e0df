"""Registered queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import centroids
from sensorloom.llm.registry import query, table


def _lloyd_sql() -> str:
    """All rounds as one statement; every round has an assignment ``a`` and centroids ``c``."""
    steps = [
        """
kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
flat AS (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS i FROM kept),
c0 AS (
  SELECT c, unnest(v) AS x, unnest(range(64)) AS i
  FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM kept ORDER BY c LIMIT 40))"""
    ]
    for r in range(centroids.ROUNDS + 1):
        steps.append(
            f"""
d{r} AS (
  SELECT vec_id, c, sum((flat.x - c{r}.x) * (flat.x - c{r}.x)) AS d FROM flat JOIN c{r} USING (i) GROUP BY vec_id, c),
a{r} AS (SELECT vec_id, min({{'d': d, 'c': c}}) AS m FROM d{r} GROUP BY vec_id)"""
        )
        if r < centroids.ROUNDS:
            steps.append(
                f"""
s{r} AS (SELECT m.c AS c, i, sum(x) AS s, count(*) AS n FROM flat JOIN a{r} USING (vec_id) GROUP BY m.c, i),
c{r + 1} AS (SELECT c{r}.c, coalesce((s - ((s % n) + n) % n) // n, c{r}.x) AS x, c{r}.i FROM c{r} LEFT JOIN s{r} ON s{r}.c = c{r}.c AND s{r}.i = c{r}.i)"""
            )
    last = centroids.ROUNDS
    return f"""
WITH {",".join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(x AS BIGINT), ',' ORDER BY i)) AS h FROM c{last} GROUP BY c)
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
  CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{last} JOIN h ON h.c = m.c"""


@query(_lloyd_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after five rounds."""
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))
