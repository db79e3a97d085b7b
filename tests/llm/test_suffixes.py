import random

import numpy as np
import pyarrow as pa
import pytest

from sarraf.llm import suffixes

SCHEMA = "doc_id long, text string, kept string, starts int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def plain(rows):
    """(bytes, kept, spans) of each row, from a table of all strings."""
    rank = lambda i: suffixes.NO_ID if i is None else i
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            s = raw[k : k + 50]
            first[s] = min(first.get(s, suffixes.NO_ID), rank(i))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < rank(i):
                gone[k : k + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((str(i), len(raw), bytes(b for b, g in zip(raw, gone) if not g), spans))
    return sorted(out)


def result(df, **options):
    return sorted((str(r.doc_id), r.n_bytes, bytes(r.kept), len(r.starts)) for r in suffixes.cut_repeats(df, **options).collect())


def shared_passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(5, 40))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.randrange(30))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages))
        if i % 7 == 0:
            parts.append(rng.choice(passages)[5:])
        rows.append((i, " ".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, rows[3][1][1:]), (None, rows[5][1]), (None, rows[5][1]), (7, rows[8][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [2, 5000])
@pytest.mark.parametrize("segment", [500, 1 << 20])
def test_cuts_are_those_of_a_table_of_all_strings(spark, monkeypatch, hot, segment):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "MERGE_SUFFIXES", 50)
    monkeypatch.setattr(suffixes, "RANGE_ANCHORS", 200)
    rows = shared_passages(hot)
    assert result(frame(spark, rows).repartition(4), segment_bytes=segment) == plain(rows)


def test_small_alphabets_edges_and_nulls(spark):
    rng = random.Random(4)
    rows = [(i, "ab" * (i % 60)) for i in range(40)]
    rows += [(100 + i, "".join(rng.choice("ab") for _ in range(n))) for i, n in enumerate([0, 1, 49, 50, 51, 99, 100, 400] * 3)]
    rows += [(300, None), (301, ""), (302, "é" * 25), (303, "é" * 25), (304, "x" * 50), (305, "x" * 49), (306, "x" * 51)]
    assert result(frame(spark, rows)) == plain(rows)


def test_long_text_over_several_steps(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PART", 1000)
    monkeypatch.setattr(suffixes, "_powers", [])
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh ") for _ in range(12_000))
    rows = [(1, long[2000:9000]), (2, long), (3, long[5000:5050]), (4, long[11_990:] + long[:60])]
    assert result(frame(spark, rows).coalesce(1)) == plain(rows)


def in_process(rows, segment_bytes):
    """Rows of the steps before the cut, each step run on one partition here."""
    task = type("Task", (), {"get": staticmethod(lambda: type("Context", (), {"partitionId": staticmethod(lambda: 0)}))})
    whole = suffixes.TaskContext
    suffixes.TaskContext = task
    try:
        docs = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
        segments = [r for b in suffixes._segments(segment_bytes)(iter([docs])) for r in b.to_pylist()]
    finally:
        suffixes.TaskContext = whole

    def step(work, given, schema, order):
        out = [r for b in work(iter([pa.RecordBatch.from_pylist(given, schema)])) for r in b.to_pylist()]
        return sorted(out, key=lambda r: tuple(r[k] for k in order))

    with_kind = pa.schema([("kind", pa.string()), ("ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), *suffixes._ANSWER])
    together = lambda *kinds: sorted(
        [{"kind": "text", "part": 0, "n": 0, **r} for r in segments] + [{"kind": k, **r} for k, own in kinds for r in own],
        key=lambda r: (r["seg"], r["kind"], r["part"]),
    )
    asked = step(suffixes._ask(2), segments, suffixes._SEGMENT, ("part", "seg"))
    marks = step(suffixes._mark(5000), asked, suffixes._ANSWER, ("seg", "part"))
    runs = step(suffixes._suffix_runs(3), together(("marks", marks)), with_kind, ("part", "seg"))
    masks = step(suffixes._by_part(suffixes._merge), runs, suffixes._ANSWER, ("seg", "part"))
    return pa.RecordBatch.from_pylist(together(("marks", marks), ("masks", masks)), with_kind)


def test_cutting_makes_no_runs_again(monkeypatch):
    rows = [(i, t) for i, t in shared_passages(3) if i is not None]
    given = in_process(rows, 2000)
    # The runs have been merged: to cut, only the order of their suffixes is needed.
    monkeypatch.setattr(suffixes, "_runs", None)
    found = [r for b in suffixes._cut(3)(iter([given])) for r in b.to_pylist()]
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["kept"], len(r["starts"])) for r in found) == plain(rows)


def test_kinds_are_those_of_a_plain_count():
    draw = np.random.default_rng(5)
    for n in (0, 1, 2, 300):
        gram, other = draw.integers(0, 1 + n // 2, n), draw.integers(0, 3, n)
        grams, which, times = np.unique(gram, return_inverse=True, return_counts=True)
        assert suffixes._kinds(which, times, other).tolist() == [len(set(other[gram == g].tolist())) for g in grams]


def test_removed_runs_end_with_their_document(spark):
    text = "".join(random.Random(2).choice("abcdefgh") for _ in range(70))
    rows = [(1, text), (2, text), (3, ""), (4, text), (5, "new " + text), (6, None), (7, text[:60] + "!" + text[20:])]
    assert result(frame(spark, rows).coalesce(1)) == plain(rows)
    found = {r.doc_id: (list(r.starts), list(r.stops)) for r in suffixes.cut_repeats(frame(spark, rows).coalesce(1)).collect()}
    assert found == {
        1: ([], []), 2: ([0], [70]), 3: ([], []), 4: ([0], [70]), 5: ([4], [74]), 6: ([], []), 7: ([0, 61], [60, 111]),
    }


def test_empty_table(spark):
    assert result(frame(spark, []).limit(0)) == []


def test_merge_gives_byte_order_and_common_prefixes():
    rng = random.Random(8)

    class Fixed:
        def __init__(self, texts):
            self.texts, self.i = sorted(texts), -1
            pairs = zip([b"", *self.texts], self.texts)
            self.common = [next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y))) for x, y in pairs]

        def step(self):
            self.i += 1
            return self.i < len(self.texts)

        @property
        def text(self):
            return self.texts[self.i]

    for _ in range(200):
        runs = [Fixed([bytes(rng.choice(b"ab") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(5))]) for _ in range(rng.randrange(1, 8))]
        want, last, got = sorted(t for r in runs for t in r.texts), b"", []
        for number, common in suffixes.merged(runs):
            text = runs[number].text
            assert text[:common] == last[:common] and text[common : common + 1] != (last[common : common + 1] or None)
            got.append(text)
            last = text
        assert got == want
