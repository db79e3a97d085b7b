"""Alignment of the tokens of two tokenizers, and how often their ids end together.

Tokenizer A is byte-level BPE of the tokenizers library and reads a space and
the text; B is a sentencepiece model with byte fallback, reads the text and
adds the space.  The spans that the libraries report are coarse cuts: character offsets
of A, byte spans of B's result proto.  A token whose span shares a character
with the next one, and a byte-fallback token, ends inside a character; there the
decoded bytes of the tokens say where.  Byte offsets where tokens of A and B both end
cut them into groups; the tokens of A and B that end at the same offset are a link.

No token of either vocabulary crosses from other text into a space or line
break (the vocabularies are checked for that; otherwise a text is one chunk), so a text is cut into
chunks there, and each distinct chunk of a block of documents is encoded and aligned once,
many of them as one text.

Corpus-wide counts: a block gives its distinct id pairs with their links, which
are summed by pair in map tasks and a shuffle; a block gets back one row for each of its
pairs, so a very frequent pair is asked for once per block, not per link.  The most
frequent partner of each id of B is a table of the size of B's vocabulary.

Nulls: null and empty texts, and texts whose joined bytes of A or B are not the
space and the text, have no tokens: zeros and ''.  A null doc_id stays null.  Repeated rows
are documents of their own and count as often.  Empty tables give no rows; of other columns nothing is kept.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.llm.common import frugal, shuffle_tasks, stored, table
from sarraf.llm.tokens import _gathered, _packed, _packed_positions, _unpacked, _unpacked_positions, vocabulary

#: Text bytes of a block.
BLOCK_BYTES = 16 << 20
#: Distinct chunks read as one text, and such texts encoded in one call.
TOGETHER = 500
BATCH = 20
#: What such a text starts with: a chunk of its own, for the space that B adds.
FIRST = " a"

#: White space that starts with a space or line break, up to the next such place.
_CHUNK = re.compile(r"[ \n]\s*(?:\S+(?:[^\S \n]\s*(?:\S+|\Z))*)?")
#: How sentencepiece writes a space.
_SPACE = "▁"


@functools.cache
def byte_symbols() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: visible Latin-1 characters stand for themselves, others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_str(model)
        self.own.no_truncation()
        self.own.no_padding()
        self.own.encode_special_tokens = True
        symbols = byte_symbols()
        names = self.own.get_vocab(with_added_tokens=False)
        self.bytes = {i: bytes(symbols[c] for c in name) for name, i in names.items()}
        spec = json.loads(model)
        before = spec.get("pre_tokenizer") or {}
        self.splits = (
            spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space", False)
        )

    def read(self, chunks: list[str]) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
        """Ids, bytes and byte ends of each chunk."""
        for chunk, e in zip(chunks, self.own.encode_batch(chunks, add_special_tokens=False), strict=True):
            spans, own = e.offsets, [self.bytes[i] for i in e.ids]
            if chunk.isascii():
                yield e.ids, own, [end for _, end in spans]
                continue
            places = np.cumsum([0, *(len(c.encode("utf-8", "surrogatepass")) for c in chunk)]).tolist()
            ends = [places[end] for _, end in spans]
            for i in range(len(spans) - 1):
                if spans[i + 1][0] < spans[i][1]:  # ends inside a character of the next one
                    ends[i] = (ends[i - 1] if i else 0) + len(own[i])
            yield e.ids, own, ends


class Pieces:
    """Tokenizer B."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.own.get_piece_size()
        names = [self.own.id_to_piece(i) for i in range(size)]
        self.fallback = {i for i in range(size) if self.own.is_byte(i)}
        self.bytes = [
            bytes([int(n[3:5], 16)]) if i in self.fallback else n.replace(_SPACE, " ").encode() for i, n in enumerate(names)
        ]
        plain = [n for i, n in enumerate(names) if i not in self.fallback]
        # Only a leading run of spaces in a piece, no line breaks, and nothing the model rewrites.
        sample = "a  b\n\tc  ﬁ "
        self.splits = not any(_SPACE in n.lstrip(_SPACE) or "\n" in n for n in plain) and (
            self.own.normalize(sample).replace(_SPACE, " ") in (sample, " " + sample)
        )

    def read(self, chunks: list[str]) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
        """Ids, bytes and byte ends of each chunk; the space that the model adds is the chunk's own or goes again."""
        asked = [c[1:] if c[0] == " " else c for c in chunks]
        for chunk, e in zip(chunks, self.own.encode(asked, return_type="proto", num_threads=1), strict=True):
            added = 1 if chunk[0] == " " else 0
            ids, ends, at = [], [], 0
            pieces = list(e.pieces)
            if not added and pieces and pieces[0].piece == _SPACE:
                pieces = pieces[1:]
            for p in pieces:
                at = at + 1 if p.id in self.fallback else p.end + added
                ids.append(p.id)
                ends.append(at)
            if added and not pieces:  # a lone space: nothing but the prefix
                ids, ends = [self.own.piece_to_id(_SPACE)], [1]
            yield ids, [self.bytes[i] for i in ids], ends


def aligned(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> tuple[list[tuple[list[int], list[int]]], list[tuple[int, int]]]:
    """(groups, links): ids of A and B between common ends, and the pairs that end together."""
    groups, links, i, j = [], [], 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        first, second = i, j
        while i < len(a) and a_ends[i] <= cut:
            i += 1
        while j < len(b) and b_ends[j] <= cut:
            j += 1
        groups.append((a[first:i], b[second:j]))
        links += [
            (x, y) for x, p in zip(a[first:i], a_ends[first:i], strict=True) if p == cut
            for y, q in zip(b[second:j], b_ends[second:j], strict=True) if q == cut
        ]
    return groups, links


def as_text(groups: list[tuple[list[int], list[int]]]) -> str:
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


class Strings:
    """Ids as text with what follows them, by id."""

    def __init__(self, size: int, behind: str):
        self.inner = np.array([f"{i}," for i in range(size)], object)
        self.last = np.array([f"{i}{behind}" for i in range(size)], object)

    def __call__(self, ids: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.where(last, self.last[ids], self.inner[ids])


class Aligner:
    """Distinct chunks aligned many at a time, as one text."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.splits = a.splits and b.splits
        self.a_text, self.b_text = Strings(max(a.bytes) + 1, "|"), Strings(len(b.bytes), ";")
        self.fallback = np.zeros(len(b.bytes), bool)
        self.fallback[list(b.fallback)] = True

    def together(self, chunks: list[str], e, proto):
        """(sizes, texts, codes) of chunks read as one text behind ``FIRST``; None if they have to be read one by one.

        ``sizes`` has the tokens of A and B, groups and links of each chunk,
        ``codes`` the id pairs of all links in order.
        """
        whole = FIRST + "".join(chunks)
        raw = whole.encode("utf-8", "surrogatepass")
        ids, pieces = e.ids, proto.pieces
        b_ids = [p.id for p in pieces]
        a_bytes = [self.a.bytes[i] for i in ids]
        b_bytes = [self.b.bytes[i] for i in b_ids]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return None
        places = np.arange(len(raw) + 1)
        if len(raw) != len(whole):
            places = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
        ids, b_ids = np.array(ids), np.array(b_ids)
        # Coarse cuts from the spans; decoded bytes where a token ends inside a character.
        spans = np.array(e.offsets)
        a_ends = places[spans[:, 1]]
        inside = np.flatnonzero(spans[1:, 0] < spans[:-1, 1])
        a_ends[inside] = np.cumsum(list(map(len, a_bytes)))[inside]
        b_ends = np.fromiter((p.end for p in pieces), np.int64, len(b_ids)) + 1
        bytewise = np.flatnonzero(self.fallback[b_ids])
        b_ends[bytewise] = np.cumsum(list(map(len, b_bytes)))[bytewise]
        bounds = places[np.cumsum([len(FIRST), *map(len, chunks)])]
        common = np.intersect1d(a_ends, b_ends)
        if (np.diff(a_ends) <= 0).any() or (np.diff(b_ends) <= 0).any() or not np.isin(bounds, common).all():
            return None
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_last, b_last = a_ends == common[a_group], b_ends == common[b_group]
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        words = np.concatenate([self.a_text(ids, a_last), self.b_text(b_ids, b_last)])[order].tolist()
        n = len(bounds)
        n_a, n_b, n_groups = (np.bincount(np.searchsorted(bounds, x), minlength=n) for x in (a_ends, b_ends, common))
        edges = np.cumsum(n_a + n_b).tolist()
        texts = ["".join(words[x:y]) for x, y in zip(edges, edges[1:], strict=False)]
        codes = (ids[a_last].astype(np.int64) << 32 | b_ids[b_last])[n_groups[0] :]
        return np.stack([n_a, n_b, n_groups, n_groups])[:, 1:], texts, codes

    def alone(self, chunks: list[str]):
        """The same one by one, with None for the sizes of a chunk whose bytes are not those of its tokens."""
        for chunk, (a, a_bytes, a_ends), (b, b_bytes, b_ends) in zip(
            chunks, self.a.read(chunks), self.b.read(chunks), strict=True
        ):
            raw = chunk.encode("utf-8", "surrogatepass")
            if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
                yield None, "", []
                continue
            groups, links = aligned(a, a_ends, b, b_ends)
            yield (len(a), len(b), len(groups), len(links)), as_text(groups) + ";", [x << 32 | y for x, y in links]

    def read(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """(good, sizes, texts, codes) of distinct chunks."""
        good, sizes, texts, codes = np.ones(len(chunks), bool), np.zeros((4, len(chunks)), np.int64), [], [np.empty(0, np.int64)]
        lots = [chunks[i : i + TOGETHER] for i in range(0, len(chunks), TOGETHER)] if self.splits else [[c] for c in chunks]
        for start in range(0, len(lots), BATCH):
            some = lots[start : start + BATCH]
            if self.splits:
                joined = [FIRST + "".join(lot) for lot in some]
                read = zip(
                    self.a.own.encode_batch(joined, add_special_tokens=False),
                    self.b.own.encode([j[1:] for j in joined], return_type="proto", num_threads=1), strict=True,
                )
            else:
                read = itertools.repeat((None, None), len(some))
            for lot, (e, proto) in zip(some, read, strict=True):
                at = len(texts)
                found = self.together(lot, e, proto) if self.splits else None
                if found is not None:
                    sizes[:, at : at + len(lot)] = found[0]
                    texts += found[1]
                    codes.append(found[2])
                    continue
                for own, text, links in self.alone(lot):
                    if own is None:
                        good[len(texts)] = False
                    else:
                        sizes[:, len(texts)] = own
                    texts.append(text)
                    codes.append(np.array(links, np.int64))
        return good, sizes, texts, np.concatenate(codes)


@functools.lru_cache(maxsize=1)
def _aligner(model_a: str, model_b: str) -> Aligner:
    return Aligner(ByteLevel(model_a), Pieces(base64.b64decode(model_b)))


class Block:
    """Documents whose distinct chunks are encoded together."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.chunks: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.doc_ids: list = []
        self.at: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id, text: str | None) -> None:
        chunks = []
        if text:
            whole = " " + text
            chunks = _CHUNK.findall(whole) if self.aligner.splits else [whole]
            self.held += len(whole)
        self.doc_ids.append(doc_id)
        self.at.append(np.array(list(map(self.chunks.__getitem__, chunks)), np.int64))

    def _align(self) -> None:
        self.good, self.sizes, self.texts, codes = self.aligner.read(list(self.chunks))
        self.codes, self.pair = np.unique(codes, return_inverse=True)

    def row(self, block: int, digest: bool) -> pa.RecordBatch:
        """The block as one row, and its distinct pairs with their links."""
        self._align()
        used = np.zeros(len(self.good), np.int64)
        stats, shown, kept = [], [], []
        for own in self.at:
            if not len(own) or not self.good[own].all():
                own = own[:0]
            used += np.bincount(own, minlength=len(used))
            stats.append(self.sizes[:, own].sum(axis=1).tolist())
            text = "".join([self.texts[i] for i in own.tolist()])[:-1]
            shown.append(hashlib.sha256(text.encode()).hexdigest() if digest and text else text)
            kept.append(own)
        self.texts.clear()
        links = self.sizes[3] * self.good
        counts = np.bincount(self.pair, np.repeat(used, links), minlength=len(self.codes)).astype(np.int64)
        order = np.argsort(-used, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        starts = np.cumsum(links) - links
        columns = list(zip(*stats, strict=True)) or [()] * 4
        return pa.RecordBatch.from_pylist([{
            "block": block, "doc_ids": self.doc_ids, "n_a": columns[0], "n_b": columns[1], "n_groups": columns[2],
            "n_links": columns[3], "groups": shown, "sizes": [len(k) for k in kept],
            "positions": _packed_positions(rank[np.concatenate([np.empty(0, np.int64), *kept])].astype(np.uint32)),
            "links": _packed(links[order]), "pairs": _packed(_gathered(self.pair, starts[order], links[order])),
            "codes": self.codes.tolist(), "counts": counts.tolist(),
        }], _ROW)


_ROW = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("groups", pa.list_(pa.string())),
    ("sizes", pa.list_(pa.int32())), ("positions", pa.binary()), ("links", pa.binary()), ("pairs", pa.binary()),
    ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])
_ROW_SQL = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, sizes array<int>, positions binary, links binary, pairs binary, "
    "codes array<long>, counts array<long>"
)


def _blocks(model_a: str, model_b: str, block_bytes: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        block = Block(_aligner(model_a, model_b))
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc_id, text.as_py())
                if block.held >= block_bytes:
                    yield block.row(number, digest)
                    number, block = number + 1, Block(block.aligner)
        if block.doc_ids:
            yield block.row(number, digest)

    return run


_OUT_SQL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


def _with_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a block with the counts of their links; the counts of its pairs come before, in order."""

    def documents(row: dict, counts: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
        links, pairs = _unpacked(row["links"]).astype(np.int64), _unpacked(row["pairs"])
        upto = np.concatenate([[0], np.cumsum(counts[pairs])])
        most = np.concatenate([[0], np.cumsum(best[pairs])])
        ends = np.cumsum(links)
        sums, tops = upto[ends] - upto[ends - links], most[ends] - most[ends - links]
        positions = _unpacked_positions(row["positions"])
        edges = np.concatenate([[0], np.cumsum(row["sizes"])]).astype(np.int64)
        sums, tops = (np.concatenate([[0], np.cumsum(x[positions])]) for x in (sums, tops))
        names = ["doc_ids", "n_a", "n_b", "n_groups", "n_links"]
        columns = [pa.array(row[n], pa.int64()) for n in names]
        columns += [pa.array(np.diff(x[edges]), pa.int64()) for x in (tops, sums)] + [pa.array(row["groups"], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *names[1:], "n_best", "count_sum", "groups"])

    counts, best = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for batch in batches:
        at = 0
        for whole in [*np.flatnonzero(np.array(batch.column("pos")) == LAST), batch.num_rows]:
            part = batch.slice(at, whole - at)
            counts.append(np.array(part.column("n"), np.int64))
            best.append(np.array(part.column("best"), np.int64))
            if whole < batch.num_rows:
                yield documents(batch.slice(whole, 1).to_pylist()[0], np.concatenate(counts), np.concatenate(best))
                counts, best = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            at = whole + 1


#: Place of the documents behind the pairs of their block.
LAST = (1 << 31) - 1


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(code, n, best) of every id pair: its links, and whether no id of A has more with the same id of B."""
    pairs = blocks.select(F.inline(F.arrays_zip("codes", "counts")))
    n = stored(pairs.groupBy(F.col("codes").alias("code")).agg(F.sum("counts").alias("n")).filter("n > 0"), "align-pairs")
    b_id = F.col("code").bitwiseAND(F.lit(0xFFFFFFFF))
    # One row per id of B: no more than its vocabulary.
    most = n.groupBy(b_id.alias("_b")).agg(F.max("n").alias("_most"))
    return n.join(F.broadcast(most), b_id == F.col("_b")).select("code", "n", (F.col("n") == F.col("_most")).cast("long").alias("best"))


def align(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES, digest: bool = False
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every row of ``docs`` (doc_id, text).

    ``groups`` is ``a1,a2|b1;a3|b2`` in ids, or with ``digest`` its SHA-256.
    """
    model_a = Path(path_a or vocabulary("byte_bpe_50k.json")).read_text(encoding="utf-8")
    model_b = base64.b64encode(Path(path_b or vocabulary("piece_bpe_32k.model")).read_bytes()).decode()
    blocks = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            frugal(_blocks(model_a, model_b, block_bytes, digest)), _ROW_SQL
        ),
        "align-blocks",
    )
    counted = pair_counts(blocks)
    asked = blocks.select("block", F.posexplode("codes").alias("pos", "_code"))
    answers = asked.join(counted, F.col("_code") == F.col("code"), "left").select(
        "block", "pos", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("best", F.lit(0)).alias("best")
    )
    behind = blocks.drop("codes", "counts").withColumns({"pos": F.lit(LAST), "n": F.lit(0).cast("long"), "best": F.lit(0).cast("long")})
    tasks = max(shuffle_tasks(docs.sparkSession), blocks.count())
    rows = answers.unionByName(behind, allowMissingColumns=True).repartition(tasks, "block").sortWithinPartitions("block", "pos")
    return rows.mapInArrow(frugal(_with_counts), _OUT_SQL)


def op13_tokenizer_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")
