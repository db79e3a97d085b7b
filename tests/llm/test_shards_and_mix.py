import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sarraf.llm import mixing, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, slot string, target string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y", "z") for i, t, s in rows], SCHEMA)


# --- shards -------------------------------------------------------------------------

def test_shards_are_even_random_and_repeatable(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 50), f"s{i % 3}") for i in range(1000)] + [(None, None, None), (5, "", "a"), (5, "", "a")]
    docs = frame(spark, rows)
    cols = ["doc_id", "text", "lang", "source", "n_chars", "size", "target"]
    one = sharding.shard(docs.repartition(3), bucket_bytes=20_000).select("shard", "slot", *cols).collect()
    two = sharding.shard(docs.repartition(7), bucket_bytes=20_000).select("shard", "slot", *cols).collect()
    assert sorted(one, key=str) == sorted(two, key=str)
    counts = Counter(r.shard for r in one)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for k in range(8):
        assert sorted(r.slot for r in one if r.shard == k) == list(range(counts[k]))
    assert Counter((r.doc_id, r.text, r.source) for r in one) == Counter(rows)
    order = [r.doc_id or 0 for r in sorted(one, key=lambda r: (r.slot, r.shard))]
    ups = sum(a < b for a, b in zip(order, order[1:]))
    assert 400 < ups < 600 and order != sorted(order)
    other = sharding.shard(docs, bucket_bytes=20_000, seed=99).select("shard", "slot", *cols).collect()
    assert sorted(other, key=str) != sorted(one, key=str)
    written = sharding.shard(docs, bucket_bytes=20_000, path=str(tmp_path / "out"))
    assert written.count() == len(rows)


def test_shards_against_plain_python(spark):
    """Buckets by Spark's hash, everything else without Spark."""
    rows = [(i % 700, f"text {i % 900} " * (i % 40), f"s{i % 3}" if i % 7 else None) for i in range(1500)]
    docs = frame(spark, rows)
    size, seed = 20_000, 23
    n_buckets = max(8, -(-sum(len(t) + 1 for _, t, _ in rows) // size))
    marks = docs.select("doc_id", "source", "text", F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("h")).collect()
    order = []
    for bucket in range(n_buckets):
        own = sorted((r.h, r.doc_id, r.source or "", r.text) for r in marks if r.h % n_buckets == bucket)
        order += [own[k] for k in sharding.fisher_yates(len(own), (seed, bucket))]
    want = Counter((i, s, t, at % 8, at // 8) for at, (_, i, s, t) in enumerate(order))
    got = sharding.shard(docs.repartition(4), bucket_bytes=size).collect()
    assert Counter((r.doc_id, r.source or "", r.text, r.shard, r.slot) for r in got) == want


def test_no_rows_no_shards(spark):
    assert sharding.shard(frame(spark, []).limit(0)).count() == 0


def test_fisher_yates_is_a_permutation():
    assert sorted(sharding.fisher_yates(100, (1, 2)).tolist()) == list(range(100))


# --- mix -----------------------------------------------------------------------------

def plain_seats(votes, house, caps):
    """Seat by seat to the highest quotient."""
    seats = [0] * len(votes)
    for _ in range(min(house, sum(caps))):
        open_ = [i for i in range(len(votes)) if seats[i] < caps[i] and votes[i] > 0]
        if not open_:
            break
        seats[max(open_, key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))] += 1
    return seats


@pytest.mark.parametrize("votes, house, caps", [
    ([53, 24, 23], 7, [9] * 3), ([1, 1, 1], 4, [9] * 3), ([100, 1, 0], 50, [60, 60, 60]), ([5, 5], 9, [3, 9]), ([0, 0], 3, [1, 1]),
    ([], 5, []), ([1e9, 1], 1000, [400, 700]), ([3.3, 2.2, 1.1, 0.4], 321, [500] * 4),
])
def test_apportionment_is_seat_by_seat(votes, house, caps):
    assert mixing.apportion(votes, house, caps) == plain_seats(votes, house, caps)


def test_targets_stop_at_three_passes():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    assert mixing.targets([10, 100, 100], [5, 2, 1]) == [30.0, 120.0, 60.0]
    assert mixing.targets([10, 10, 1000], [5, 2, 1]) == [30.0, 30.0, 960.0]
    assert mixing.targets([0, 0], [5, 2]) == [0.0, 0.0] and mixing.targets([], []) == []


def mixed_rows():
    rows = [(i, "w " * (1 + i * 7 % 200), "big") for i in range(900)]
    rows += [(1000 + i, "w " * (1 + i % 30), f"s{i % 4}") for i in range(200)]
    return rows + [(3000, None, "s1"), (3001, "", None), (None, "a b c " * 40, None), (3, "w w", "s2"), (3, "w w", "s2")]


def test_taken_words_come_near_the_target(spark):
    rows = mixed_rows()
    quotas, plan = mixing.document_quotas(frame(spark, rows).repartition(5))
    got = quotas.collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, mixing.targets([sizes[s] for s in order], [mixing.WEIGHTS[i % 3] for i in range(len(order))])))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in order:
        assert taken[s] == pytest.approx(want[s], rel=0.03)
    again = mixing.document_quotas(frame(spark, rows).repartition(2))[0].collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    for r in plan.collect():
        assert sum(r.shard_quotas) == r.quota and min(r.shard_quotas) >= 0
    assert all(sum(r.shard_taken) == r.taken and min(r.shard_taken) >= 0 for r in got)


def test_taken_words_are_those_of_the_drawn_blocks(spark):
    """Word by word: each shard marks the words of its blocks."""
    rows = mixed_rows()
    docs = frame(spark, rows)
    quotas, plan = mixing.document_quotas(docs.repartition(3), seed=17)
    marks = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"), F.xxhash64(F.lit(17), "doc_id", "text").alias("h"), "text"
    ).collect()
    slices, want = math.isqrt(len(rows)), Counter()
    for p in plan.collect():
        own = [(r.h % slices, r.h, r.doc_id or -1, len((r.text or "").split()), r) for r in marks if r.source == p.source]
        own.sort(key=lambda o: o[:4])
        words = [k for k, o in enumerate(own) for _ in range(o[3])]
        taken = [[0] * 8 for _ in own]
        at = p.start_block
        for j, quota in enumerate(p.shard_quotas):
            for _ in range(quota):
                for k in words[at * p.block_words : (at + 1) * p.block_words]:
                    taken[k][j] += 1
                at = (at + 1) % p.n_blocks
        want.update((o[4].doc_id, p.source, o[4].text_hash, tuple(t)) for o, t in zip(own, taken, strict=True))
    assert Counter((r.doc_id, r.source, r.text_hash, tuple(r.shard_taken)) for r in quotas.collect()) == want


def test_small_sources_do_not_set_the_blocks_of_others():
    sizes = [3, 0, 5_000, 400_000, 900_000]
    goal = mixing.targets(sizes, [5, 2, 1, 5, 2])
    quotas = mixing.shard_quotas(goal, sizes, 8)
    assert [mixing.block_size(s) for s in sizes] == [1, 1, 32, 2048, 2048]
    for g, s, q in zip(goal, sizes, quotas, strict=True):
        assert abs(sum(q) * mixing.block_size(s) - g) <= max(1, 0.02 * g)
        assert max(q) - min(q) <= max(2, 0.2 * max(q))


def test_mix_repeats_whole_rows_and_keeps_columns(spark):
    docs = frame(spark, mixed_rows())
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert set(r.doc_id for r in got if r.doc_id is not None) <= {i for i, _, _ in mixed_rows()}
    words = Counter()
    for r in got:
        words[r.source] += len(r.text.split())
    plan = {r.source: r.target for r in mixing.document_quotas(docs)[1].collect()}
    assert all(words[s] == pytest.approx(t, rel=0.1) for s, t in plan.items() if t > 1000)


def test_empty_table(spark):
    empty = frame(spark, []).limit(0)
    assert mixing.document_quotas(empty)[0].count() == 0 and mixing.mix(empty).count() == 0
