"""Clusters of integer vectors around centroids, with a LAESA table of pivot distances.

A component ``x`` becomes the integer floor(``scale`` * x), so distances, sums
and centroids are exact.  A few pivots are chosen once, far from each other,
from a bounded sample; the distance of every vector to every pivot is stored
with the vector and never computed again.  In each round the centroids are
measured against the pivots, and by the triangle inequality

    distance(vector, centroid) >= |distance(vector, pivot) - distance(centroid, pivot)|

holds for every pivot.  The centroid with the lowest bound is measured first;
centroids whose bound is above that distance are out, the others get their
exact integer distance.  Bounds are lowered by more than their rounding error and only
strictly greater ones count, so ties are still decided by number.

A round is one pass over the stored table.  Each task sums its vectors per
centroid, so ``k`` rows of a task are shuffled and ``k`` sums reach the driver,
where the next centroids are made: nothing there grows with the input.  A
cluster with nearly all vectors costs no task more than others.

Vectors that are null, have another number of components or hold nulls or
non-finite components are left out.  Scaled components beyond ``LARGEST`` count as
that, so that distances fit 64 bits (vectors of unit length are far below); sums of distances
beyond 64 bits are given as the greatest 64-bit integer.  Repeated rows are
vectors of their own and may start clusters of their own; vectors without
vec_id start none.  With fewer than ``k`` vectors there are fewer clusters, and
an empty table gives no rows.  Of other columns nothing is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.llm.common import frugal, stored, table

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
PIVOTS = 8
#: Vectors the pivots are chosen from; all vectors are clustered.
SAMPLE = 1024
LARGEST = 1 << 27
#: More than the relative rounding error of a pivot distance, or of a bound.
SLACK = 1e-9
LONGEST = (1 << 63) - 1


def _readable(dimensions: int, scale: int):
    """vec_id and the integer components of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            own = np.array(vectors.value_lengths().fill_null(-1)) == dimensions
            picked = batch.filter(pa.array(own))
            if not picked.num_rows:
                continue
            flat = picked.column("embedding").flatten()
            x = np.array(flat.cast(pa.float64()).fill_null(float("nan"))).reshape(-1, dimensions)
            good = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                q = np.clip(np.floor(x[good] * scale), -LARGEST, LARGEST).astype("<i4")
            ids = picked.column("vec_id").filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([ids, pa.array([r.tobytes() for r in q], pa.binary())], ["vec_id", "q"])

    return run


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), -1 if len(column) else 0)


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to a point."""
    away = vectors - point
    return np.einsum("ij,ij->i", away, away)


def choose_pivots(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Rows of ``sample`` (int64) far from each other: each the farthest from those before it."""
    if not len(sample):
        return sample
    pivots = [0]
    near = squared(sample, sample[0])
    while len(pivots) < wanted and near.max() > 0:
        pivots.append(int(near.argmax()))
        near = np.minimum(near, squared(sample, sample[pivots[-1]]))
    return sample[pivots]


def _pivot_table(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("q"), "<i4").astype(np.int64)
            far = np.sqrt(np.stack([squared(q, p) for p in pivots], axis=1).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("q"), pa.array([r.tobytes() for r in far], pa.binary())],
                ["vec_id", "q", "far"],
            )

    return run


def nearest(q: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, its squared distance) of each row of ``q``, and how many distances that took."""
    k = len(centroids)
    reach = np.sqrt(np.stack([squared(centroids, p) for p in pivots], axis=1).astype(np.float64))
    bound = np.zeros((len(q), k))
    for at in range(len(pivots)):
        a, b = far[:, at, None], reach[None, :, at]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    best, least = bound.argmin(axis=1), np.zeros(len(q), np.int64)
    for c in range(k):
        rows = np.flatnonzero(best == c)
        least[rows] = squared(q[rows], centroids[c])
    first, taken = best.copy(), len(q)
    for c in range(k):
        rows = np.flatnonzero((first != c) & (bound[:, c] ** 2 <= least * (1 + SLACK)))
        own = squared(q[rows], centroids[c])
        taken += len(rows)
        closer = (own < least[rows]) | ((own == least[rows]) & (c < best[rows]))
        best[rows[closer]], least[rows[closer]] = c, own[closer]
    return best, least, taken


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray):
    for batch in batches:
        if batch.num_rows:
            q = _matrix(batch.column("q"), "<i4").astype(np.int64)
            yield batch, q, *nearest(q, _matrix(batch.column("far"), "<f8"), centroids, pivots)


def _round_sums(centroids: np.ndarray, pivots: np.ndarray):
    """Per centroid of a task: its vectors, the sums of their components, and the distances computed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, work = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64), 0
        for _, q, best, _, taken in _assigned(batches, centroids, pivots):
            counts += np.bincount(best, minlength=len(centroids))
            for c in np.unique(best):
                sums[c] += q[best == c].sum(axis=0)
            work += taken
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.arange(len(centroids)), pa.int32()), "n": pa.array(counts),
            "sums": pa.array(sums.tolist(), pa.list_(pa.int64())),
            "work": pa.array([work] + [0] * (len(centroids) - 1), pa.int64()),
        })

    return run


def _final_rows(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, best, least, _ in _assigned(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(least)], ["vec_id", "cluster", "distance"]
            )

    return run


def _moved(rounds: DataFrame, before: np.ndarray) -> np.ndarray:
    """The next centroids: floors of the exact means; empty clusters stay.  ``k`` rows reach the driver."""
    dims = before.shape[1]
    totals = rounds.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    )
    after = before.copy()
    for row in totals.filter("n > 0").collect():
        after[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(dims)]
    return after


def cluster(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
    n_pivots: int = PIVOTS, seed: int = SEED, on_round: Callable[[DataFrame], None] | None = None,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of the vectors of ``vectors`` (vec_id, embedding), and the final centroids.

    The ``k`` vectors whose ids have the smallest hashes start the clusters.
    ``on_round`` sees the sums of each round (cluster, n, sums, work), for measurements.
    """
    read = stored(
        vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
            frugal(_readable(dimensions, scale)), "vec_id long, q binary"
        ),
        "cluster-vectors",
    )
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = read.filter("vec_id is not null").orderBy(hashed, "q").limit(k).select("q").toArrow()
    drawn = read.orderBy(F.xxhash64("q", "vec_id"), "q").limit(SAMPLE).select("q").toArrow()
    centroids = _matrix(starts.column("q"), "<i4").reshape(-1, dimensions).astype(np.int64)
    pivots = choose_pivots(_matrix(drawn.column("q"), "<i4").reshape(-1, dimensions).astype(np.int64), n_pivots)
    kind = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return read.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    measured = stored(
        read.mapInArrow(frugal(_pivot_table(pivots)), "vec_id long, q binary, far binary"), "cluster-pivots"
    )
    for _ in range(rounds):
        sums = measured.mapInArrow(
            _round_sums(centroids, pivots), "cluster int, n long, sums array<long>, work long"
        )
        if on_round:
            on_round(sums)
        centroids = _moved(sums, centroids)
    return stored(measured.mapInArrow(frugal(_final_rows(centroids, pivots)), kind), "cluster-final"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the sums of distances and a digest of the final centroid; one row per cluster reaches the driver."""
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    per_cluster = {r.cluster: int(r.s) for r in sums}
    whole = min(sum(per_cluster.values()), LONGEST)
    rows = [
        (c, min(total, LONGEST), whole, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, total in per_cluster.items()
    ]
    named = assigned.sparkSession.createDataFrame(rows, "_number int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), F.col("cluster") == F.col("_number")).drop("_number")


def op11_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster(table(spark, sf_dir, "embeddings")))


def _sql(k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> str:
    """The same in plain rounds: every distance of every round is computed."""
    steps = [f"""
WITH read AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE len(embedding) = {dimensions}
), v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: floor(x * {SCALE})::BIGINT) AS q FROM read
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), q) - 1)::INTEGER AS c, q FROM v
  WHERE vec_id IS NOT NULL QUALIFY c < {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(d) AS d, arg_min(c, (d, c)) AS c FROM (
    SELECT v.r, c.c, list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM v, c{i} c) GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN (
    SELECT c, list(floor_mean ORDER BY i) AS q FROM (
      SELECT a.c, i, (sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*) AS floor_mean
      FROM (SELECT r, unnest(q) AS x, unnest(range({dimensions})) AS i FROM v) u JOIN a{i} a USING (r) GROUP BY a.c, i)
    GROUP BY c) m ON c.c = m.c
)""")
    return ",\n".join(steps) + f"""
SELECT v.vec_id, a.c AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
  sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (r) JOIN c{rounds} c ON a.c = c.c
"""


OP11_SQL = _sql()
