import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sarraf.llm import alignment

SCHEMA = "doc_id long, text string, n_a string, groups string"
TEXTS = [
    None, "", " ", "\n", "  \n ", "Hello wörld, don't", " leading and trailing ", "a\nb\n\n c\t\td \r\n e f 　g", "日本語 テキスト 🙂🙂",
    "x▁y", "▁", "<|endoftext|> <s></s> <unk> <0x41>", "naïve é İ ΑΣ é", "12345 67.8e-9 $$$", "word " * 300, "ab" * 3000,
    "tab\tonly", "nul\0byte \x1c\x1d\x85", "﻿bom", "fiﬁ ½ Ω", "word", "word", "\n\nx", "x\n", "x ", "x \n y", "क्षि ไทย العربية",
]


@pytest.fixture(scope="module")
def plain():
    """Whole texts, every token by its decoded bytes."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    symbols = alignment.byte_symbols()

    def ends(parts):
        at, out = 0, []
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    def run(rows):
        docs, counts = [], Counter()
        for doc_id, text in rows:
            groups, links, ia, ib = [], [], [], []
            if text:
                raw = (" " + text).encode()
                ia = a.encode(" " + text, add_special_tokens=False).ids
                ib = b.encode(text)
                pa = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ia]
                pb = []
                for i in ib:
                    name = b.id_to_piece(i)
                    byte = re.fullmatch(r"<0x([0-9A-F]{2})>", name) if b.is_byte(i) else None
                    pb.append(bytes([int(byte[1], 16)]) if byte else name.replace("▁", " ").encode())
                if b"".join(pa) == raw == b"".join(pb):
                    ea, eb = ends(pa), ends(pb)
                    low = 0
                    for cut in sorted(set(ea) & set(eb)):
                        groups.append((
                            [i for i, e in zip(ia, ea, strict=True) if low < e <= cut],
                            [i for i, e in zip(ib, eb, strict=True) if low < e <= cut],
                        ))
                        low = cut
                    links = [(x[-1], y[-1]) for x, y in groups]
                else:
                    ia, ib = [], []
            counts.update(links)
            docs.append((doc_id, ia, ib, groups, links))
        most = Counter()
        for (_, y), n in counts.items():
            most[y] = max(most[y], n)
        out = []
        for doc_id, ia, ib, groups, links in docs:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append((
                doc_id, len(ia), len(ib), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
                sum(counts[p] for p in links), text,
            ))
        return out

    return run


def collected(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [50, 1 << 20])
def test_against_whole_texts(spark, plain, block_bytes):
    rows = [*enumerate(TEXTS), (0, "x y"), (0, "x y"), (None, "a b c")]
    docs = spark.createDataFrame([(i, t, "q", "q") for i, t in rows], SCHEMA).repartition(3)
    assert collected(alignment.align(docs, block_bytes=block_bytes)) == sorted(plain(rows), key=repr)
    assert sum(bool(r[1]) for r in plain(rows)) > 20


def test_tokens_that_end_together():
    groups, links = alignment.aligned([1, 2, 3], [1, 4, 6], [7, 8, 9], [2, 4, 6])
    assert groups == [([1, 2], [7, 8]), ([3], [9])] and links == [(2, 8), (3, 9)]
    assert alignment.as_text(groups) == "1,2|7,8;3|9"
    assert alignment.aligned([], [], [], []) == ([], [])


def test_chunks_read_together_and_alone_agree():
    from sarraf.llm.tokens import vocabulary

    a = alignment.ByteLevel(open(vocabulary("byte_bpe_50k.json"), encoding="utf-8").read())
    b = alignment.Pieces(open(vocabulary("piece_bpe_32k.model"), "rb").read())
    assert a.splits and b.splits
    aligner = alignment.Aligner(a, b)
    chunks = list(dict.fromkeys(c for t in TEXTS if t for c in alignment._CHUNK.findall(" " + t)))
    plain_ones = [c for c in chunks if "▁" not in c]
    good, sizes, texts, codes = aligner.read(plain_ones)
    alone = list(aligner.alone(plain_ones))
    assert good.all() and [tuple(x) for x in sizes.T.tolist()] == [x[0] for x in alone]
    assert texts == [x[1] for x in alone] and codes.tolist() == [c for x in alone for c in x[2]]
    assert aligner.read(chunks)[0].tolist() == ["▁" not in c for c in chunks]
    aligner.splits = False
    assert aligner.read(plain_ones)[2] == texts


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert alignment.align(docs).count() == 0


def test_query_over_the_whole_table(spark, plain):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in plain(rows)]
    got = alignment.op13_tokenizer_spans(spark, sf_dir).withColumnRenamed("groups_sha256", "groups")
    assert collected(got) == sorted(expected, key=repr)
