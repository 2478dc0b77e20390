"""Centroid clustering with Orchard's search.

Lloyd's rounds on whole numbers: a vector's components are floor(1024 x).
A round's centroids and, for each of them, the list of the others by distance
travel with the tasks (k vectors and k * k numbers, bounded by ``k``).  A
vector starts at centroid 0 and walks down its list; whenever a centroid is
closer, the search jumps to that one's list.  Visited centroids are marked and
not measured again.  The search stops strictly beyond twice the present
distance, where no centroid can be as close.  All arithmetic is exact, on
64-bit integers.

The kept vectors are written once.  A round is one pass over them: a task
returns a count and a sum per centroid, which Spark adds up, and k rows reach
the driver.

Defined results: vectors of another length or with a null, NaN or infinite
component are left out; a vector whose id is null takes part but starts no
centroid unless too few have an id (it comes last, ties by components);
repeated rows count as often as they occur; with fewer than ``k`` vectors
there are fewer centroids; an empty table gives no row; a component of 32,768
or more raises an error, as distances would leave the 64 bits; only ``vec_id``
and ``embedding`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Whole components stay below this, so four times a squared distance fits 64 bits.
LARGEST = 1 << 25


def whole_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v): the vectors that are kept, as whole numbers."""
    wide = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = wide.where((F.size("x") == dimensions) & finite)
    small = F.forall("x", lambda x: F.abs(x * SCALE) < LARGEST - 1)
    scaled = F.transform("x", lambda x: F.floor(x * SCALE).cast("int"))
    return kept.select("vec_id", F.when(small, scaled).otherwise(F.raise_error(F.lit("a component is too large"))).alias("v"))


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid the others from near to far, and how far (squared)."""
    k = len(centroids)
    gaps = np.stack([squares(centroids - c) for c in centroids])
    gaps[np.arange(k), np.arange(k)] = -1  # itself first, even before its doubles
    order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(gaps, order, axis=1)


def nearest(points: np.ndarray, centroids: np.ndarray, lists: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point (the smallest number on a tie) and the squared distance."""
    n, k = len(points), len(centroids)
    best, dist = np.zeros(n, np.int64), squares(points - centroids[0])
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    at = np.zeros(n, np.int64)  # the place in the list of the present centroid
    live = np.arange(n if k > 1 else 0)
    while len(live):
        live = live[at[live] < k - 1]
        live = live[gaps[best[live], at[live]] <= 4 * dist[live]]
        there = lists[best[live], at[live]]
        at[live] += 1
        fresh = ~seen[live, there]
        x, c = live[fresh], there[fresh]
        seen[x, c] = True
        d = squares(points[x] - centroids[c])
        closer = (d < dist[x]) | ((d == dist[x]) & (c < best[x]))
        x, c = x[closer], c[closer]
        best[x], dist[x], at[x] = c, d[closer], 0
    return best, dist


def _points(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def _summer(centroids: np.ndarray):
    """Count and sum of the points next to each centroid, one row per centroid and task."""
    lists, gaps = neighbour_lists(centroids)
    k, dimensions = centroids.shape

    def run(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            points = _points(batch, dimensions)
            best, _ = nearest(points, centroids, lists, gaps)
            order = np.argsort(best, kind="stable")
            found, first, n = np.unique(best[order], return_index=True, return_counts=True)
            if len(found):
                counts[found] += n
                sums[found] += np.add.reduceat(points[order], first, axis=0)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
                              names=["cluster", "n", "sums"])
    return run


def _assigner(centroids: np.ndarray):
    lists, gaps = neighbour_lists(centroids)

    def run(batches):
        for batch in batches:
            best, dist = nearest(_points(batch, centroids.shape[1]), centroids, lists, gaps)
            yield pa.record_batch([batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(dist)], names=["vec_id", "cluster", "distance"])
    return run


def first_centroids(points: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.select("v", hashed.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; one without points stays."""
    sums = points.mapInArrow(_summer(centroids), "cluster int, n long, sums array<long>")
    columns = [F.sum(F.col("sums")[i]) for i in range(centroids.shape[1])]
    out = centroids.copy()
    for r in sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*columns).alias("sums")).collect():
        out[r.cluster] = [s // r.n for s in r.sums]
    return out


def cluster(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """Per vector its centroid and distance, the inertias, and the centroid's components."""
    points = materialise(whole_vectors(embeddings, dimensions))
    kind = dict(points.dtypes)["vec_id"]
    centroids = first_centroids(points, k, seed).reshape(-1, dimensions)
    spark = points.sparkSession
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    for _ in range(rounds):
        centroids = moved(points, centroids)
    found = materialise(points.mapInArrow(_assigner(centroids), f"vec_id {kind}, cluster int, distance long"))
    inertia = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    per = spark.createDataFrame([(c, d, sum(inertia.values()), centroids[c].tolist()) for c, d in inertia.items()],
                                "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def cluster_report(embeddings: DataFrame, **how) -> DataFrame:
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return cluster(embeddings, **how).withColumn("centroid_sha256", digest).drop("centroid")


def _round_sql(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (SELECT rid, min({{'d': d, 'c': c}}) AS m FROM (SELECT k.rid, c.c,
    list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(k.v, c.v)])::BIGINT AS d FROM k, c{i} c) GROUP BY rid),
s{i} AS (SELECT m.c AS c, i, sum(v[i])::BIGINT AS s, count(*) AS n
  FROM a{i} JOIN k USING (rid), (SELECT unnest(range(1, {DIMENSIONS + 1})) AS i) GROUP BY 1, 2),
c{i + 1} AS MATERIALIZED (SELECT p.c, coalesce(x.v, p.v) AS v FROM c{i} p LEFT JOIN
  (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY c) x ON p.c = x.c)"""


ORACLE = f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
    [floor({SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM
  (SELECT sha256('{SEED}:' || vec_id) AS h, v FROM k ORDER BY h, v LIMIT {CLUSTERS})),
{",".join(_round_sql(i) for i in range(ROUNDS))},
last AS (SELECT rid, min({{'d': d, 'c': c}}) AS m FROM (SELECT k.rid, c.c,
    list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(k.v, c.v)])::BIGINT AS d FROM k, c{ROUNDS} c) GROUP BY rid)
SELECT vec_id, m.c::INT AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
  (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM last JOIN k USING (rid) JOIN c{ROUNDS} c ON c.c = m.c
"""
