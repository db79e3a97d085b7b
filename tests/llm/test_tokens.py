import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sarraf.llm import tokens

TEXTS = [
    None, "", " \n\t ", "Hello wOrld's  don't WE'LL", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "naïve é İ ΑΣ 日本語 🙂",
    "x y z \u0085q", "1234 5.6e-7 ###", "a " * 5000, "ab" * 30_000, "same same same",
]
SCHEMA = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own.no_truncation()
    own.no_padding()
    return own


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("block_bytes", [64, 1 << 20])
def test_ids_and_texts_are_those_of_the_library(spark, library, monkeypatch, block_bytes):
    monkeypatch.setattr(tokens, "SLICE_WORDS", 100)
    monkeypatch.setattr(tokens, "CHUNK_IDS", 50)
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r for r in tokens.encode(frame(spark, rows).repartition(3), block_bytes=block_bytes).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].ids == ids
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = frame(spark, [(1, "a b"), (1, "a b"), (None, "a b")])
    assert sorted((str(r.doc_id), len(r.ids)) for r in tokens.encode(docs).collect()) == [("1", 2), ("1", 2), ("None", 2)]
    assert tokens.digests(tokens.encode(docs.limit(0))).count() == 0


def test_query_over_the_whole_table(spark, library):
    import hashlib

    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in tokens.op3_distinct_words(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
