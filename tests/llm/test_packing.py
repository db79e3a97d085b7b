import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sarraf.llm import packing
from sarraf.llm.packing import Limits, Piece, pack, pack_block, powers

SCHEMA = "example_id long, ids array<int>, loss array<boolean>, sequence_id string, ids_crc32 string"


def piece(name, n, loss=None):
    return Piece(name, n, 0, np.arange(n), None if loss is None else np.arange(n) < loss)


def checked(rows, limits):
    """The pieces by example, after all limits of each sequence are checked; also the share of padding."""
    sequences, examples = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        examples[r.example_id].append(r)
    used = padded = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limits.capacity and len(own) <= limits.max_segments
        assert sum(r.n_loss for r in own) <= limits.max_loss
        used += at
        padded += at if at & (at - 1) == 0 else limits.capacity
    return examples, 1 - used / padded if padded else 0.0


def test_room_decides_by_dot_product():
    # Loss is scarce: after the big piece, the pieces without loss fill the sequence first.
    limits = Limits(capacity=100, max_segments=10, max_loss=60, least_cut=5)
    closed, now = pack_block([piece("a", 50, 50), piece("b", 30, 30), piece("c", 50, 0), piece("d", 30, 10)], limits)
    assert {p.example for p in closed[0]} == {"a", "c"}
    assert {p.example for p in now} == {"b", "d"}


def test_segments_cuts_and_ends():
    limits = Limits(capacity=64, max_segments=4, max_loss=64, least_cut=8)
    closed, now = pack_block([piece(i, 1) for i in range(10)], limits)
    assert [len(c) for c in closed] == [4, 4] and len(now) == 2
    closed, now = pack_block([piece("long", 200), piece("x", 40), piece("y", 40)], limits)
    assert [sum(len(p.ids) for p in c) for c in closed] == [64, 64, 64, 64] and sum(len(p.ids) for p in now) == 24
    assert [sum(len(p.ids) for p in c) for c in powers([piece("z", 11), piece("w", 2)])] == [8, 4, 1]
    with pytest.raises(ValueError):
        Limits(max_loss=0)


@pytest.mark.parametrize("limits", [
    Limits(capacity=64, max_segments=5, max_loss=30, least_cut=4, block_examples=37),
    Limits(capacity=64, max_segments=64, max_loss=64, least_cut=4, block_tokens=500),
])
def test_examples_come_back_whole(spark, limits):
    draw = np.random.default_rng(4)
    rows = []
    for i in range(600):
        n = int(draw.integers(0, 40)) if i % 50 else 300
        loss = None if i % 3 == 0 else (draw.random(n) < 0.3).tolist()
        rows.append((i, draw.integers(0, 1000, n).tolist(), loss, "x", "y"))
    rows += [(1000, None, None, "x", "y"), (1001, [5, 6, 7], [True], "x", "y"), (1002, [5, 6], [], "x", "y")]
    rows += [(1003, [9], [True, True, True], "x", "y"), (1004, [], [True], "x", "y"), (1005, [1] * 100, [False] * 100, "x", "y")]
    got = pack(spark.createDataFrame(rows, SCHEMA).repartition(7), limits).collect()
    examples, padding = checked(got, limits)
    for i, ids, loss, *_ in rows:
        own = sorted(examples.get(i, []), key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == (ids or [])
        assert [r.start for r in own] == [sum(len(q.ids) for q in own[:k]) for k in range(len(own))]
        assert all(r.example_tokens == len(ids) for r in own)
        wanted = [True] * len(ids or []) if loss is None else ([*loss] + [False] * len(ids))[: len(ids)] if ids else []
        masks = [x for r in own for x in (r.loss if r.loss is not None else [True] * r.length)]
        assert masks == wanted and sum(r.n_loss for r in own) == sum(wanted)
    if limits.max_segments == 64:
        assert padding < 0.02
    again = pack(spark.createDataFrame(rows, SCHEMA).repartition(7), limits).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_words_are_encoded_as_the_library_does(spark):
    texts = [
        None, "", "Don't WE'LL it's a's's 'tis x'd", "a<|endoftext|>b <|startoftext|>, <|ENDOFTEXT|>", "naïve, é. İstanbul ΑΣ. 日本語! 🙂?",
        "1234 5.6e-7 ### a_b \x1c\x1d q\u0085r x\u00a0y", "ab" * 30_000, "été, Été; e\u0301te\u0301.", "word " * 3000, "_ __ -- ...",
    ]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = packing.pack_documents(docs.repartition(2), Limits(capacity=512, max_loss=512)).collect()
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.example_id == i), key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == [*library.encode(text or "", add_special_tokens=False).ids, 2]
    checked(rows, Limits(capacity=512, max_loss=512))


def test_runs_are_cut_as_the_vocabulary_cuts_them():
    text = "Don't we'll 'tis a's's ''s x'd12 it's- (a_b) O'Reilly've \x1cq  é.'s a<|b 'S\t"
    places, runs = packing.runs_of(text.encode())
    assert [r.as_py().decode() for r in runs] == [
        "don", "'t", "we", "'ll", "'t", "is", "a", "'s", "'s", "''", "s", "x", "'d", "1", "2", "it", "'s", "-", "(", "a", "_", "b", ")",
        "o", "'re", "illy", "'ve", "\x1c", "q", "é.'s", "a<|b", "'s",
    ]
    assert all(text.encode().lower()[p:].startswith(r.as_py()) for p, r in zip(places.tolist(), runs, strict=True))


def test_each_run_is_learned_once_whatever_stands_beside_it():
    words = packing.WordIds(Path(packing.vocabulary()).read_text(encoding="utf-8"))
    assert [len(ids) for ids in words.of([b"cat, dog. (cat) dog's cat;dog", b"", b"CAT dog.cat's 'dog'"])] == [12, 0, 8]
    assert len(words.numbers) == len({"cat", "dog", ",", ".", "(", ")", "'s", ";", "'", "'d", "og"})


@pytest.mark.parametrize("step", [1, 7, 60, 1 << 20])
def test_ids_are_those_of_the_library_for_any_texts(monkeypatch, step):
    monkeypatch.setattr(packing, "STEP", step)
    monkeypatch.setattr(packing, "WORDS", 40)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = packing.WordIds(Path(packing.vocabulary()).read_text(encoding="utf-8"))
    draw = np.random.default_rng(step)
    signs = [*"''''sstdmlreveLLTx09 \t\n.,-_<|>é́ÀİΣß日ñ🙂\x1c\x00\u0085 ²Ⅷ", "'re", "'ll", "<|endoftext|>", "<|EndOfText|>"]
    for _ in range(40):
        texts = ["".join(draw.choice(signs, int(n))) for n in draw.integers(0, 50, 8)]
        for text, ids in zip(texts, words.of([t.encode() for t in texts]), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, [1, 2, 3], None, "", ""), (1, [1, 2, 3], None, "", ""), (None, [4], None, "", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sum(r.length for r in pack(frame).collect()) == 7
    assert pack(frame.limit(0)).count() == 0


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    rows = packing.op12_dot_product_packing(spark, sf_dir).withColumnRenamed("doc_id", "example_id").collect()
    examples, padding = checked(rows, Limits())
    assert padding < 0.005
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(examples) == len(docs)
    for d in docs:
        ids = np.array([*library.encode(d.text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(examples[d.doc_id], key=lambda r: r.start)
        at = 0
        for r in own:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
