import random

from sarraf.llm import neardup
from sarraf.llm.components import components

SCHEMA = "doc_id long, text string, component_id long, n_shingles long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None) for i, t in rows], SCHEMA)


def plain(rows, width, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        own = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets[i] = own
    best = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while True:
        before = dict(best)
        for a, b in links:
            best[a] = best[b] = min(best[a], best[b])
        if best == before:
            return {i: (len(sets[i]), best[i]) for i in sets}


def near(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"z{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed=1):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 200))]
        for k in range(rng.choice([1, 2, 3, 12])):
            rows.append((i := i + 1, near(rng, base, k % 3)))
    rows += [(i + 1, None), (i + 2, ""), (i + 3, " \n"), (i + 4, "one two"), (i + 5, "ONE\ttwo"), (i + 6, rows[0][1])]
    rng.shuffle(rows)
    return rows


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_links_and_components_as_compared_one_by_one(spark):
    rows = corpus()
    assert result(neardup.near_duplicates(frame(spark, rows))) == plain(rows, 5)
    assert result(neardup.near_duplicates(frame(spark, rows), width=4)) == plain(rows, 4)


def test_crowded_regions(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, near(rng, base, 1 + k % 4)) for k in range(120)]
    monkeypatch.setattr(neardup, "REGION", 16)
    got, expected = result(neardup.near_duplicates(frame(spark, rows))), plain(rows, 5)
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in expected.items()}
    # Longer prefixes can miss pairs that are barely similar: with such small regions, a few.
    assert sum(got[i] == expected[i] for i in got) >= 0.95 * len(got)


def test_crowded_regions_lose_no_link(spark, monkeypatch):
    """Copies that link to their base only, and copies of copies, in regions far over the size of a task."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(200)]
    rows = [(500, " ".join(base))] + [(k, near(rng, base, 7)) for k in range(150)]
    monkeypatch.setattr(neardup, "REGION", 32)
    assert result(neardup.near_duplicates(frame(spark, rows))) == plain(rows, 5)


def test_pairs_held_back_are_found_in_the_second_round(spark):
    """Two close groups that only meet beyond their smallest members."""
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 200])) for k in range(12)]  # a chain: only neighbours link
    assert result(neardup.near_duplicates(frame(spark, rows))) == plain(rows, 5)


def test_one_row_of_each_group_stays(spark):
    rows = [(3, "a b c d e f g"), (2, "A b c d e f g"), (9, "other words are here now ok"), (None, "a b c d e f g"), (4, None)]
    rows += [(9, "other words are here now ok")]
    kept = neardup.keep_one(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "component_id", "n_shingles"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 4, 9, 9, None]


def test_empty_table_and_long_text(spark):
    assert neardup.near_duplicates(frame(spark, []).limit(0)).count() == 0
    long = " ".join(f"w{k}" for k in range(100_000))
    got = result(neardup.near_duplicates(frame(spark, [(1, long), (2, long + " end")])))
    assert got == {1: (99_996, 1), 2: (99_997, 1)}


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(1, 51)} == {0} and {got[k] for k in range(101, 140)} == {100} and got[200] == 199
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
