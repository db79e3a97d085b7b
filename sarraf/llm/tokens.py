"""BPE encoding and decoding by way of a table of distinct words.

White space never joins tokens of this vocabulary, so a text is encoded word by
word.  The words of a block of documents (one input split) are numbered, and
each document becomes a row of word numbers.  The distinct words of all blocks
meet by hash of the word, where each distinct word is encoded once; the ids go
back to the blocks that asked and are put in place by the word numbers of each
position.  Requests, ids and positions travel packed, one binary value for each
block and slice of the words, since most distinct words are rare and
single rows would cost several times the text.

Decoding puts ids and the pieces of the vocabulary together in one columnar
take: the id-to-piece table has the fixed size of the vocabulary and is sent to
every task.  Like the vocabulary's own decoder, pieces are joined by a space.

A word is in a request once per block, so a very frequent word is no hot key; a block
has at most ``BLOCK_BYTES`` and one document.

Nulls: a null text is empty and has no ids.  Repeated rows are encoded alike;
documents are never cut.  Empty tables give no rows.  Of other columns only
doc_id is kept; a null doc_id stays null.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.llm.common import frugal, shuffle_tasks, stored, table

#: Text bytes of a block.
BLOCK_BYTES = 32 << 20
#: Distinct words that one slice of the word table has at most, if every block asks for other words.
SLICE_WORDS = 400_000
#: Documents put in place at once.
CHUNK_IDS = 1_000_000

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a tokenizer file of the installed public set."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def _tokenizer(model: str):
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(model)
    own.no_truncation()
    own.no_padding()
    return own


@functools.lru_cache(maxsize=2)
def _pieces(model: str) -> pa.Array:
    """The id-to-piece table: piece of each id."""
    by_piece = _tokenizer(model).get_vocab(with_added_tokens=True)
    names = [""] * (max(by_piece.values()) + 1)
    for piece, i in by_piece.items():
        names[i] = piece
    return pa.array(names, pa.string())


def _packed(values: np.ndarray) -> bytes:
    """Numbers with their bytes grouped by place, compressed."""
    return zstandard.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 9)


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


#: Numbers below this take one byte; words are numbered by frequency.
COMMON = 240


def _packed_positions(numbers: np.ndarray) -> bytes:
    """Numbers that are mostly small: a byte each, the rest as numbers of their own."""
    common = zstandard.compress(np.minimum(numbers, COMMON).astype(np.uint8).tobytes(), 9)
    return len(common).to_bytes(8, "little") + common + _packed(numbers[numbers >= COMMON])


def _unpacked_positions(raw: bytes) -> np.ndarray:
    cut = 8 + int.from_bytes(raw[:8], "little")
    numbers = np.frombuffer(zstandard.decompress(raw[8:cut]), np.uint8).astype(np.uint32)
    numbers[numbers == COMMON] = _unpacked(raw[cut:])
    return numbers


_ROW = pa.schema([
    ("block", pa.int64()), ("slice", pa.int32()), ("n", pa.int64()), ("words", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("positions", pa.binary()),
])
_ROW_SQL = (
    "block long, slice int, n long, words binary, doc_ids array<long>, sizes array<int>, positions binary"
)


def _block_rows(block: int, numbers: dict[bytes, int], docs: list, sizes: list[int], at: list[np.ndarray], slices: int):
    """The documents of a block as word numbers, and the words it asks for, slice by slice in the order of their numbers."""
    positions = np.concatenate([np.empty(0, np.uint32), *at])
    at.clear()
    order = np.argsort(-np.bincount(positions, minlength=len(numbers)), kind="stable")
    rank = np.empty(len(numbers), np.uint32)
    rank[order] = np.arange(len(numbers))
    words = list(numbers)
    numbers.clear()
    words = [words[i] for i in order.tolist()]
    of_slice = np.fromiter((zlib.crc32(w) % slices for w in words), np.uint32, len(words))
    asked: list[list[bytes]] = [[] for _ in range(slices)]
    for word, i in zip(words, of_slice.tolist(), strict=True):
        asked[i].append(word)
    del words
    rows = [{"block": block, "slice": -1, "n": len(docs), "words": _packed(of_slice), "doc_ids": docs, "sizes": sizes,
             "positions": _packed_positions(rank[positions])}]
    del positions
    for i, some in enumerate(asked):
        if some:
            rows.append({"block": block, "slice": i, "n": len(some), "words": zstandard.compress(b"\n".join(some), 9)})
    return pa.RecordBatch.from_pylist(rows, _ROW)


def _number_words(slices: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        numbers, docs, sizes, at, held = {}, [], [], [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc, text in zip(ids, batch.column("text"), strict=True):
                raw = (text.as_py() or "").encode()
                words = raw.split()
                if len(words):
                    own = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint32, len(words))
                    at.append(own)
                docs.append(doc)
                sizes.append(len(words))
                held += len(raw)
                if held >= block_bytes:
                    yield _block_rows(block, numbers, docs, sizes, at, slices)
                    block += 1
                    numbers, docs, sizes, at, held = {}, [], [], [], 0
        if docs:
            yield _block_rows(block, numbers, docs, sizes, at, slices)

    return run


def _encode_words(model: str):
    """Each distinct word of a slice is encoded once; every block gets the ids of the words it asked for."""

    def answers(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        asked = [zstandard.decompress(r["words"]).split(b"\n") for r in rows]
        words = sorted(set().union(*asked))
        index = {w: i for i, w in enumerate(words)}
        found = []
        for at in range(0, len(words), 50_000):
            some = [w.decode() for w in words[at : at + 50_000]]
            found += [e.ids for e in _tokenizer(model).encode_batch_fast(some, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum()))
        starts = np.cumsum(counts) - counts
        for row, own in zip(rows, asked, strict=True):
            which = np.fromiter(map(index.__getitem__, own), np.int64, len(own))
            yield pa.RecordBatch.from_pylist(
                [{"block": row["block"], "slice": row["slice"], "n": row["n"],
                  "words": _packed(counts[which]), "positions": _packed(_gathered(flat, starts[which], counts[which]))}],
                _ROW,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["slice"] != rows[0]["slice"]:
                    yield from answers(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from answers(rows)

    return run


def _gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + count]`` one after the other."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return flat[np.arange(total) + np.repeat(starts - (ends - counts), counts)]


def decode_arrow(ids: pa.ListArray, model: str) -> pa.Array:
    """Texts of rows of ids: a columnar take from the id-to-piece table, pieces joined by a space."""
    pieces = _pieces(model).take(ids.flatten())
    base = pc.subtract(ids.offsets, ids.offsets[0])
    return pc.binary_join(pa.ListArray.from_arrays(base, pieces), " ")


def _put_in_place(model: str):
    def documents(answers: list[dict], row: dict) -> Iterator[pa.RecordBatch]:
        of_slice = _unpacked(row["words"])
        starts, counts = np.zeros(len(of_slice), np.int64), np.zeros(len(of_slice), np.int64)
        flats, done = [np.empty(0, np.uint32)], 0
        for a in answers:
            places, own = np.flatnonzero(of_slice == a["slice"]), _unpacked(a["words"]).astype(np.int64)
            counts[places] = own
            starts[places] = done + np.cumsum(own) - own
            flats.append(_unpacked(a["positions"]))
            done += len(flats[-1])
        flat = np.concatenate(flats)
        positions, sizes = _unpacked_positions(row["positions"]), np.array(row["sizes"], np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        reach = np.concatenate([[0], np.cumsum(counts[positions])])
        at = 0
        while at < len(sizes):
            stop = int(np.searchsorted(reach[edges], reach[edges[at]] + CHUNK_IDS, side="right"))
            stop = max(at + 1, min(stop - 1, len(sizes)))
            own = positions[edges[at] : edges[stop]]
            offsets = reach[edges[at : stop + 1]] - reach[edges[at]]
            ids = _gathered(flat, starts[own], counts[own]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"][at:stop], pa.int64()), lists, decode_arrow(lists, model)],
                ["doc_id", "ids", "decoded"],
            )
            at = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if answers and answers[0]["block"] != row["block"]:
                    answers = []
                if row["slice"] >= 0:
                    answers.append(row)
                    continue
                yield from documents(answers, row)
                answers = []

    return run


def encode(docs: DataFrame, path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ids and decoded text of every row of ``docs`` (doc_id, text); ``path`` is the tokenizer file."""
    spark = docs.sparkSession
    model = Path(path or vocabulary()).read_text(encoding="utf-8")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # The input has size / 6 words or so; distinct in a block are a fifth of them at most.
    slices = max(1, -(-size // (30 * SLICE_WORDS)))
    numbered = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(_number_words(slices, block_bytes)), _ROW_SQL),
        "token-blocks",
    )
    tasks = shuffle_tasks(spark)
    asked = numbered.filter("slice >= 0").repartition(tasks, "slice").sortWithinPartitions("slice", "block")
    answered = asked.mapInArrow(frugal(_encode_words(model)), _ROW_SQL)
    # Answers come before the documents of their block.
    rows = answered.union(numbered.filter("slice < 0")).repartition(tasks, "block").sortWithinPartitions(
        "block", F.col("slice").desc()
    )
    return rows.mapInArrow(frugal(_put_in_place(model)), "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of ids and decoded text, with ``more`` columns of ``encoded``."""
    return encoded.select(
        "doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents")))
