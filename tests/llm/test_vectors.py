import numpy as np

from sarraf.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in rows], SCHEMA)


def plain(rows, cosine=0.9):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and None not in list(v)]
    good = [(i, v / np.linalg.norm(v)) for i, v in good if np.isfinite(v).all() and v.any()]
    unit = np.array([v for _, v in good])
    like = unit @ unit.T >= cosine
    np.fill_diagonal(like, False)
    out = {i: [0, i] for i, _ in rows}
    names = np.array([i for i, _ in good])
    label = names.copy()
    for _ in range(len(names)):
        label = np.minimum(label, np.where(like, label[None, :], 10**9).min(axis=1))
    for i, n, c in zip(names, like.sum(axis=1), label):
        out[int(i)] = [int(n), int(c)]
    return out


def result(df, **options):
    return {r.vec_id: [r.n_links, r.component_id] for r in vectors.near_vectors(df, **options).collect()}


def cloud(rng, n, d=32):
    rows = [rng.standard_normal(d) for _ in range(n)]
    for spread in (0.05, 0.2, 0.3):
        centre = rng.standard_normal(d)
        rows += [centre + spread * rng.standard_normal(d) for _ in range(40)]
    return list(enumerate(rows))


def test_links_and_components_as_compared_one_by_one(spark):
    rows = cloud(np.random.default_rng(1), 300)
    rows += [(1000, rows[5][1]), (1001, rows[5][1]), (1002, rows[5][1] * 3), (1003, None), (1004, np.zeros(32)), (1005, [None] * 32),
             (1006, [float("nan")] * 32), (1007, [float("inf")] * 32)]
    got, want = result(frame(spark, rows)), plain(rows)
    found, all_ = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and found >= 0.99 * all_
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)


def test_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 10)
    rng = np.random.default_rng(2)
    rows = [(i, np.ones(16) + 0.05 * rng.standard_normal(16)) for i in range(150)]
    assert result(frame(spark, rows)) == plain(rows)


def test_repeated_rows_other_lengths_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 1.0]), (None, [1.0, 0.0])]
    got = sorted((str(r.vec_id), r.n_links, r.component_id) for r in vectors.near_vectors(frame(spark, rows)).collect())
    assert got == [("1", 2, 1), ("1", 2, 1), ("2", 2, 1), ("3", 0, 3), ("4", 0, 4), ("None", 0, None)]
    assert result(frame(spark, []).limit(0)) == {}
    assert result(frame(spark, [(1, None)])) == {1: [0, 1]}


def test_every_length_is_linked(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.standard_normal(3)) for i in range(60)] + [(100 + i, [1.0, 0.0]) for i in range(4)]
    rows += [(200 + i, np.ones(16) + 0.05 * rng.standard_normal(16)) for i in range(20)] + [(300, [2.0])]
    got = result(frame(spark, rows))
    for length in (1, 2, 3, 16):
        own = [r for r in rows if len(r[1]) == length]
        if len(own) > 1:
            assert {i: got[i] for i, _ in own} == plain(own)
    assert got[300] == [0, 300] and got[100] == [3, 100]


def test_rotation_is_a_rotation():
    sample = np.random.default_rng(3).standard_normal((500, 8)) * np.arange(1, 9)
    turn = vectors.learn_rotation(sample, 1)
    assert np.allclose(turn @ turn.T, np.eye(8))
