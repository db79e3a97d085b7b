"""The stages one after the other against plain versions of each."""

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sarraf.llm import pii, quality

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows of the input and after each stage, each stage written and read again."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(900, None, None, None, None), (901, "", "en", "src1", 0), (902, "too short", "en", "src1", 9)], docs.schema
    )
    docs = docs.union(odd)
    out = {"input": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return out


def norm(line):
    return b" ".join(b"".join(b"0" if 48 <= c <= 57 else bytes([c]) for c in line.lower()).split())


def test_quality_rules(steps):
    texts, holders = Counter(), Counter()
    for source, text in {(r.source, r.text) for r in steps["input"]}:
        texts[source] += 1
        holders.update({(source, norm(x)) for x in (text or "").encode().split(b"\n") if x.split()})
    want = {}
    for r in steps["input"]:
        raw = (r.text or "").encode()
        words, lines = raw.split(), raw.split(b"\n")
        gone = [x for x in lines if (n := holders[r.source, norm(x)]) > 20 and n * 100 > 5 * texts[r.source]]
        repeats = quality.text_stats(r.text)[4]
        lost = sum(len(x.split()) for x in gone)
        if len(words) >= 20 and 100 * repeats <= 30 * len(words) and lost * 100 <= 70 * len(words):
            want[r.doc_id] = b"\n".join(x for x in lines if x not in gone).decode()
    assert {r.doc_id: r.text for r in steps["quality_rules"]} == want
    assert all(r.n_chars == len(r.text) for r in steps["quality_rules"])


def test_near_duplicates(steps):
    rows = {r.doc_id: r for r in steps["quality_rules"]}
    sets = {}
    for i, r in rows.items():
        w = r.text.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    best = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in links:
        for a, b in links:
            best[a] = best[b] = min(best[a], best[b])
    assert sorted(steps["near_duplicates"]) == sorted(r for i, r in rows.items() if best[i] == i)


def test_personal_data(steps):
    want = {r.doc_id: pii.redacted(r.text, pii.find_spans(r.text)) for r in steps["near_duplicates"]}
    got = {r.doc_id: r.text for r in steps["personal_data"]}
    assert got == want
    assert not any(s[0] in pii.BASE_KINDS for t in got.values() for s in pii.find_spans(t))


def test_source_mix(steps):
    before = Counter(steps["personal_data"])
    after = Counter(steps["source_mix"])
    assert set(after) <= set(before) and all(after[r] <= 3 * before[r] for r in after)
    sizes, taken = Counter(), Counter()
    for r, n in before.items():
        sizes[r.source] += n * len(r.text.split())
    for r, n in after.items():
        taken[r.source] += n * len(r.text.split())
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), rel=0.1)


def test_token_ids(steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in steps["source_mix"])
    assert Counter((r.doc_id, tuple(r.ids)) for r in steps["token_ids"]) == want
    assert all(r.n_tokens == len(r.ids) for r in steps["token_ids"])


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_stages_are_the_whole_run(spark, steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "personal_data", "source_mix", "token_ids"
    ]
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    own = {r.doc_id for r in steps["token_ids"]}
    assert {r.doc_id for r in got.collect()} & own
