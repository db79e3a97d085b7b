import hashlib

import duckdb
import numpy as np
import pytest

from sarraf.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string"


def plain(rows, k, rounds, dims):
    """Every distance of every round in Python integers: {(vec_id, cluster, distance): copies} and the centroids."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            scaled = [int(np.floor(float(np.float32(x)) * clusters.SCALE)) for x in v]
            kept.append((vec_id, [max(-clusters.LARGEST, min(clusters.LARGEST, x)) for x in scaled]))
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), np.array(q, "<i4").tobytes(), q) for i, q in kept if i is not None)
    centroids = [q for _, _, q in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), n) for n, c in enumerate(centroids)) for _, q in kept]

    for _ in range(rounds):
        own = assign()
        for n in range(len(centroids)):
            members = [q for (_, q), (_, c) in zip(kept, own, strict=True) if c == n]
            if members:
                centroids[n] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    return sorted(((i, c, d) for (i, _), (d, c) in zip(kept, assign() if centroids else [], strict=False)), key=repr), centroids


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(4)


def test_against_plain_rounds(spark):
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((6, 5))
    rows = [(i, (centres[i % 6] + 0.2 * draw.standard_normal(5)).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.5] * 5) for i in range(40)]  # ties
    rows += [(7, [0.1] * 5), (7, [0.1] * 5), (None, [0.2] * 5), (2001, None), (2002, []), (2003, [1.0] * 4)]
    rows += [(2004, [1.0, None, 1.0, 1.0, 1.0]), (2005, [float("nan")] * 5), (2006, [float("inf")] * 5)]
    rows += [(2007, [-0.0005] * 5), (2008, [3e38, -3e38, 0.0, 0.0, 0.0])]
    for k, rounds in ((4, 6), (1, 2), (8, 0)):
        got, centroids = clusters.cluster(frame(spark, rows), k=k, rounds=rounds, dimensions=5, n_pivots=3)
        expected, wanted = plain(rows, k, rounds, 5)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected
        assert centroids.tolist() == wanted


def test_equal_vectors_few_vectors_and_none(spark):
    same = [(i, [0.25] * 5) for i in range(30)]
    got, centroids = clusters.cluster(frame(spark, same), k=3, rounds=2, dimensions=5)
    assert {(r.cluster, r.distance) for r in got.collect()} == {(0, 0)} and len(centroids) == 3
    few = clusters.with_inertia(*clusters.cluster(frame(spark, same[:2]), k=8, dimensions=5)).collect()
    assert len(few) == 2 and few[0].inertia == few[0].cluster_inertia == 0
    for none in (same[:0], [(1, None)], [(None, [0.25] * 5)]):
        assert clusters.with_inertia(*clusters.cluster(frame(spark, none), dimensions=5)).count() == 0


def test_bounds_spare_distances(spark):
    """On separated groups most centroids are ruled out by the pivots; results do not depend on the number of pivots."""
    draw = np.random.default_rng(2)
    centres = 10 * draw.standard_normal((8, 64))
    rows = [(i, (centres[i % 8] + 0.1 * draw.standard_normal(64)).tolist()) for i in range(800)]
    work = []
    got, centroids = clusters.cluster(
        frame(spark, rows), on_round=lambda sums: work.append(sum(r.work for r in sums.collect()))
    )
    other, again = clusters.cluster(frame(spark, rows), n_pivots=1)
    assert centroids.tolist() == again.tolist()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, other.collect()))
    assert len(work) == 10 and work[-1] < 0.5 * 8 * 800


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    expected = con.execute(clusters.OP11_SQL)
    names = [d[0] for d in expected.description]
    got = clusters.op11_laesa_clusters(spark, sf_dir)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(expected.fetchall(), key=repr)
