"""Packing of tokenised examples into training sequences: vector bin packing by dot products.

A sequence holds at most ``capacity`` tokens, ``max_segments`` pieces and
``max_loss`` tokens that bear loss, all at once.  The sequence that is open
takes the piece whose demand (tokens, segments, loss tokens, each as a share of its limit)
has the greatest dot product with the room that is left, weighted by how much
of each limit all waiting pieces ask for; so a sequence short of one limit prefers pieces
that use the others.  When no whole piece fits, a waiting piece is cut so that its
head fills the sequence, if head and tail have ``least_cut`` tokens or more.

Each task packs the examples of its partition in blocks of bounded size, with
no shuffle; what fills no whole sequence waits for the next block.  Only the
open end of a partition, less than a sequence, is left over: those ends meet
in groups of ``ENDS`` partitions and are packed in the same way.  The last
sequence of a group is cut into sequences whose lengths are powers of two,
which need no padding.

Nulls: null ids, like empty ones, give no pieces; a null loss mask means that
every token bears loss; a null example id stays null.  A mask that is shorter
than its ids is false beyond its end.  Repeated rows are examples of their own.  Examples
longer than a sequence are cut, never dropped.  Empty tables give no rows; other
columns are not kept.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.llm.common import frugal, shuffle_tasks, stored, table
from sarraf.llm.tokens import _gathered, _tokenizer, vocabulary

CAPACITY = 4096
MAX_SEGMENTS = 256
LEAST_CUT = 16
#: Id after each document.
END_ID = 2
#: Examples and tokens that are packed together.
BLOCK_EXAMPLES = 2048
BLOCK_TOKENS = 4 << 20
#: Open ends of partitions that are packed together.
ENDS = 256
#: Distinct runs, and their bytes, whose ids a task remembers.
WORDS = 400_000
WORD_BYTES = 32 << 20
#: Bytes of texts that are encoded at once; only a longer word exceeds them.
STEP = 8 << 20
#: Ids of a batch of results.
CHUNK_IDS = 1_000_000


#: Kinds of bytes: white space, letters, digits, all others.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[list(b" \t\n\v\f\r")] = _SPACE
_KINDS[list(b"abcdefghijklmnopqrstuvwxyz")] = _LETTER
_KINDS[list(b"0123456789")] = _DIGIT
_SPACES = re.compile(rb"[ \t-\r]")
#: A word of letters with marks behind it.
_MARKED = re.compile(r"(.*[^\W\d_])([.,;:!?]+)")


def _short_endings(low: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, lengths) of 's, 't, 're, 've, 'm, 'll and 'd; an apostrophe behind another mark belongs to that."""
    at = np.flatnonzero(low == ord("'"))
    at = at[(at == 0) | (kinds[at - 1] != _OTHER)]
    after = np.concatenate([low, np.zeros(2, np.uint8)])
    x, y = after[at + 1], after[at + 2]
    two = (x == ord("r")) & (y == ord("e")) | (x == ord("v")) & (y == ord("e")) | (x == ord("l")) & (y == ord("l"))
    size = np.where(np.isin(x, list(b"stmd")), 2, np.where(two, 3, 0))
    return at[size > 0], size[size > 0]


def runs_of(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """(places, bytes) of the runs of a text that the vocabulary encodes on their own.

    ASCII words fall into lower-case runs of letters, single digits, short endings and runs of other marks;
    a word that the vocabulary may read otherwise is one run as it stands.
    """
    raw, low = np.frombuffer(text, np.uint8), np.frombuffer(text.lower(), np.uint8)
    kinds = _KINDS[low]
    new = kinds == _DIGIT
    new[:1] = True
    new[1:] |= kinds[1:] != kinds[:-1]
    at, size = _short_endings(low, kinds)
    new[at + 1] = False
    stop = at + size
    new[stop[stop < len(new)]] = True
    there = kinds != _SPACE
    new &= there

    odd = raw >= 128
    odd[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
    odd = np.flatnonzero(odd)
    if len(odd):
        edges = np.flatnonzero(np.diff(there, prepend=False, append=False))
        begins, ends = edges[::2], edges[1::2]
        words = np.unique(np.searchsorted(begins, odd, side="right") - 1)
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[begins[words]] = 1
        inside[ends[words]] = -1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        new &= ~inside
        new[begins[words]] = True
        low = np.where(inside, raw, low)
    data = low[there]
    offsets = np.append(np.flatnonzero(new[there]), len(data)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return np.flatnonzero(new), runs


def parts_of(word: str) -> list[str]:
    """A word of letters, which are letters too when the vocabulary has normalised them, and the marks behind it; another word is one part."""
    marked = None if "<|" in word else _MARKED.fullmatch(word)
    letters = marked and marked[1].isalpha() and unicodedata.normalize("NFC", marked[1]).lower().isalpha()
    return [marked[1], marked[2]] if letters else [word]


@functools.lru_cache(maxsize=2)
def _plain_tokenizer(model: str):
    """The tokenizer of lower-case ASCII runs with a space between, which leaves nothing to normalise or cut."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    plain = Tokenizer.from_str(model)
    plain.no_truncation()
    plain.no_padding()
    plain.normalizer = normalizers.Sequence([])
    bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
    return plain


class WordIds:
    """Ids of texts.

    Tokens of this vocabulary never reach over runs of letters or marks, so each
    distinct run is encoded once; and since every run ends in a token that says so,
    many are encoded as one text and told apart again.  The runs of many texts are cut and told
    apart as one column.
    """

    def __init__(self, model: str):
        self.own, self.plain = _tokenizer(model), _plain_tokenizer(model)
        names = self.own.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(names.values()) + 3, bool)
        self.last[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        self.held = 0
        self.flat, self.starts, self.counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.parts: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.part_flat, self.part_starts, self.part_counts = self.flat, self.starts, self.counts

    def _alone(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.own.encode_batch_fast(parts, add_special_tokens=False)]

    def _together(self, own, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of parts that are one run each."""
        groups = [parts[i : i + 500] for i in range(0, len(parts), 500)]
        ids, counts = [], []
        for group, e in zip(groups, own.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            some = np.array(e.ids, np.int32)
            ends = np.flatnonzero(self.last[some]) + 1
            if len(ends) != len(group):  # some part is not one run after all
                found = self._alone(group)
                some = np.fromiter(itertools.chain.from_iterable(found), np.int32)
                ends = np.cumsum([len(x) for x in found])
            ids.append(some)
            counts.append(np.diff(ends, prepend=0))
        return np.concatenate([np.empty(0, np.int32), *ids]), np.cumsum(np.concatenate([np.empty(0, np.int64), *counts]))

    def _odd(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of words that may be more than one run; parts that were seen before are not encoded again."""
        split = list(map(parts_of, words))
        known = len(self.parts)
        n = np.fromiter(map(len, split), np.int64, len(split))
        which = np.fromiter(map(self.parts.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(n.sum()))
        new = list(itertools.islice(self.parts, known, None))
        single = np.array([p.isalpha() or p.isascii() and "<|" not in p for p in new], bool)
        flat, ends = self._together(self.own, [p for p, one in zip(new, single.tolist(), strict=True) if one])
        rest = self._alone([p for p, one in zip(new, single.tolist(), strict=True) if not one])
        counts, starts = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        counts[single] = np.diff(ends, prepend=0)
        starts[single] = ends - counts[single]
        counts[~single] = [len(x) for x in rest]
        starts[~single] = len(flat) + np.cumsum(counts[~single]) - counts[~single]
        self.part_starts = np.concatenate([self.part_starts, len(self.part_flat) + starts])
        self.part_counts = np.concatenate([self.part_counts, counts])
        self.part_flat = np.concatenate([self.part_flat, flat, np.fromiter(itertools.chain.from_iterable(rest), np.int32)])
        reach = np.concatenate([[0], np.cumsum(self.part_counts[which])])
        return _gathered(self.part_flat, self.part_starts[which], self.part_counts[which]), reach[np.cumsum(n)]

    def _learn(self, runs: list[bytes]) -> None:
        """Put the ids of new runs behind those known."""
        odd = np.array([b"<|" in r or not r.isascii() for r in runs], bool)
        counts, starts, at = np.empty(len(runs), np.int64), np.empty(len(runs), np.int64), len(self.flat)
        flats = [self.flat]
        for encode, own in ((functools.partial(self._together, self.plain), ~odd), (self._odd, odd)):
            flat, ends = encode([r.decode("utf-8", "replace") for r in itertools.compress(runs, own.tolist())])
            counts[own] = np.diff(ends, prepend=0)
            starts[own] = at + ends - counts[own]
            flats.append(flat)
            at += len(flat)
        self.starts, self.counts = np.concatenate([self.starts, starts]), np.concatenate([self.counts, counts])
        self.flat = np.concatenate(flats)

    def _numbers(self, runs: pa.Array) -> np.ndarray:
        told = runs.dictionary_encode()
        known = len(self.numbers)
        distinct = told.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        if len(self.numbers) > known:
            new = list(itertools.islice(self.numbers, known, None))
            self.held += sum(map(len, new))
            self._learn(new)
        return which[told.indices.to_numpy()]

    def of(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if len(self.numbers) > WORDS or self.held > WORD_BYTES:
            self._forget()
        text = b"\n".join(texts)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        edges = np.zeros(len(begins), np.int64)
        ids, at, done = [np.empty(0, np.int32)], 0, 0
        while at < len(text):
            space = _SPACES.search(text, at + STEP)
            stop = space.start() if space else len(text)
            places, runs = runs_of(text[at:stop])
            which = self._numbers(runs)
            reach = np.concatenate([[0], np.cumsum(self.counts[which])])
            here = slice(*np.searchsorted(begins, [at, stop]))
            edges[here] = done + reach[np.searchsorted(places, begins[here] - at)]
            ids.append(_gathered(self.flat, self.starts[which], self.counts[which]))
            at, done = stop, done + int(reach[-1])
        edges[np.searchsorted(begins, at) :] = done
        flat = np.concatenate(ids)
        for x, y in itertools.pairwise(edges.tolist()):
            yield flat[x:y]


def _encoded(model: str, end: int | None):
    """Rows of documents (doc_id, text) as examples: all tokens bear loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray, None]]:
        words = WordIds(model)
        last = np.array([] if end is None else [end], np.int32)

        def examples(names: list, texts: list[bytes]) -> Iterator[tuple[object, np.ndarray, None]]:
            for name, ids in zip(names, words.of(texts), strict=True):
                yield name, np.concatenate([ids, last]), None

        for batch in batches:
            names, texts, held = [], [], 0
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                names.append(name)
                texts.append(text.as_py() or b"")
                held += len(texts[-1])
                if held >= STEP:
                    yield from examples(names, texts)
                    names, texts, held = [], [], 0
            yield from examples(names, texts)

    return run


@dataclass
class Piece:
    """A run of tokens of an example, where ``before`` tokens of the example precede it."""

    example: object
    total: int
    before: int
    ids: np.ndarray
    loss: np.ndarray | None
    n_loss: int = field(init=False)

    def __post_init__(self):
        self.n_loss = len(self.ids) if self.loss is None else int(self.loss.sum())

    def head(self, tokens: int, loss: int) -> int:
        """Length of the longest start with no more than that."""
        tokens = min(tokens, len(self.ids))
        if self.loss is None:
            return min(tokens, loss)
        return int(np.searchsorted(np.cumsum(self.loss[:tokens]), loss, side="right"))

    def cut(self, at: int) -> tuple[Piece, Piece]:
        a, b = (None, None) if self.loss is None else (self.loss[:at], self.loss[at:])
        return (
            Piece(self.example, self.total, self.before, self.ids[:at], a),
            Piece(self.example, self.total, self.before + at, self.ids[at:], b),
        )


@dataclass(frozen=True)
class Limits:
    capacity: int = CAPACITY
    max_segments: int = MAX_SEGMENTS
    max_loss: int = CAPACITY
    least_cut: int = LEAST_CUT
    block_examples: int = BLOCK_EXAMPLES
    block_tokens: int = BLOCK_TOKENS

    def __post_init__(self):
        if min(self.capacity, self.max_segments, self.max_loss, self.least_cut) < 1:
            raise ValueError("all limits must be 1 or more")

    def fitted(self, piece: Piece) -> list[Piece]:
        """The piece, cut where it exceeds a whole sequence."""
        out = []
        while len(piece.ids) > self.capacity or piece.n_loss > self.max_loss:
            start, piece = piece.cut(piece.head(self.capacity, self.max_loss))
            out.append(start)
        return [*out, piece] if len(piece.ids) else out


def pack_block(pieces: list[Piece], limits: Limits) -> tuple[list[list[Piece]], list[Piece]]:
    """(closed sequences, pieces of the open one)."""
    waiting = [p for piece in pieces for p in limits.fitted(piece)]
    tokens = np.array([len(p.ids) for p in waiting], np.int64)
    loss = np.array([p.n_loss for p in waiting], np.int64)
    # Weight of each limit: how much of it all pieces ask for.
    by_tokens, by_loss = tokens.sum() / limits.capacity, loss.sum() / limits.max_loss
    by_segments = len(waiting) / limits.max_segments
    closed, now, room, segments, spare = [], [], limits.capacity, limits.max_segments, limits.max_loss
    while waiting:
        i = -1
        if segments:
            # A piece takes its share of each limit; the dot product is with the share that is left of it.
            score = tokens * (by_tokens * room / limits.capacity**2) + loss * (by_loss * spare / limits.max_loss**2)
            score += by_segments * segments / limits.max_segments**2
            score[(tokens > room) | (loss > spare)] = -1
            i = int(score.argmax())
            i = i if score[i] >= 0 else -1
        if i >= 0:
            piece = waiting[i]
            waiting[i], tokens[i], loss[i] = waiting[-1], tokens[-1], loss[-1]
            waiting.pop()
            tokens, loss = tokens[:-1], loss[:-1]
        else:
            i, at, piece = int(tokens.argmax()), 0, None
            if segments and room >= limits.least_cut:
                at = min(waiting[i].head(room, spare), len(waiting[i].ids) - limits.least_cut)
            if at >= limits.least_cut:
                piece, waiting[i] = waiting[i].cut(at)
                tokens[i] -= len(piece.ids)
                loss[i] -= piece.n_loss
        if piece is not None:
            now.append(piece)
            room, segments, spare = room - len(piece.ids), segments - 1, spare - piece.n_loss
        if piece is None or not room:
            closed.append(now)
            now, room, segments, spare = [], limits.capacity, limits.max_segments, limits.max_loss
    return closed, now


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces as sequences whose lengths are powers of two, longest first."""
    out, left = [], list(pieces)
    n = sum(len(p.ids) for p in left)
    while n:
        room = 1 << (n.bit_length() - 1)
        n -= room
        out.append([])
        while room:
            piece = left.pop(0)
            if len(piece.ids) > room:
                piece, rest = piece.cut(room)
                left.insert(0, rest)
            out[-1].append(piece)
            room -= len(piece.ids)
    return out


_SCHEMA = pa.schema([
    ("example_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("n_loss", pa.int64()),
    ("example_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids_crc32", pa.int64()),
    ("_end", pa.int64()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_())),
])
_SQL = (
    "example_id long, start long, length long, n_loss long, example_tokens long, sequence_id long, offset long, "
    "ids_crc32 long, _end long, ids array<int>, loss array<boolean>"
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _rows(sequences: list[list[Piece]], first: int, digest: bool, end: int | None = None) -> Iterator[pa.RecordBatch]:
    """Sequences numbered from ``first``, or with ``end`` the pieces of an open one."""
    rows, held = [], 0
    for number, pieces in enumerate(sequences):
        at = 0
        for p in pieces:
            shown = (None, None) if digest and end is None else (p.ids, p.loss)
            rows.append((
                p.example, p.before, len(p.ids), p.n_loss, p.total, first + number if end is None else None, at,
                zlib.crc32(p.ids.astype("<u4").tobytes()), end, *shown,
            ))
            at += len(p.ids)
        held += at
        if held >= CHUNK_IDS:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _lists(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The lists of a column one by one, as arrays of their own."""
    edges, flat = np.array(column.offsets), column.values.to_numpy(zero_copy_only=False)
    for i, there in enumerate(np.array(column.is_valid())):
        yield flat[edges[i] : edges[i + 1]].copy() if there else None


def _given(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray | None, np.ndarray | None]]:
    """Rows that are examples already (example_id, ids, loss)."""
    for batch in batches:
        yield from zip(
            batch.column("example_id").to_pylist(), _lists(batch.column("ids")), _lists(batch.column("loss")), strict=True
        )


def _pack_partition(read: Callable, limits: Limits, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        done, block, held = 0, [], 0
        for example, ids, loss in read(batches):
            if ids is None or not len(ids):
                continue
            if loss is not None:
                mask = np.zeros(len(ids), bool)
                mask[: len(loss)] = loss[: len(ids)].astype(bool)
                loss = mask
            block.append(Piece(example, len(ids), 0, ids, loss))
            held += len(ids)
            if len(block) >= limits.block_examples or held >= limits.block_tokens:
                closed, block = pack_block(block, limits)
                yield from _rows(closed, (task << 32) + done, digest)
                done, held = done + len(closed), sum(len(p.ids) for p in block)
        closed, block = pack_block(block, limits)
        yield from _rows(closed, (task << 32) + done, digest)
        yield from _rows([block], 0, digest, end=task)

    return run


def _pack_ends(limits: Limits, digest: bool):
    def finish(group: int, pieces: list[Piece]) -> Iterator[pa.RecordBatch]:
        closed, rest = pack_block(pieces, limits)
        yield from _rows(closed + powers(rest), (1 << 62) + (group << 32), digest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pieces = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("_group", "example_id", "example_tokens", "start"))
            for g, example, total, before, ids, loss in zip(
                *columns, _lists(batch.column("ids")), _lists(batch.column("loss")), strict=True
            ):
                if pieces and g != group:
                    yield from finish(group, pieces)
                    pieces = []
                group = g
                pieces.append(Piece(example, total, before, ids, loss if loss is None else loss.astype(bool)))
        if pieces:
            yield from finish(group, pieces)

    return run


def _packed(rows: DataFrame, read: Callable, limits: Limits, digest: bool) -> DataFrame:
    packed = stored(rows.mapInArrow(frugal(_pack_partition(read, limits, digest)), _SQL), "packed")
    ends = packed.filter("sequence_id is null")
    groups = max(1, -(-ends.select("_end").distinct().count() // ENDS))
    dealt = ends.withColumn("_group", F.pmod(F.xxhash64("_end"), F.lit(groups)))
    dealt = dealt.repartition(min(groups, shuffle_tasks(rows.sparkSession)), "_group").sortWithinPartitions("_group", "_end", "offset")
    last = dealt.mapInArrow(frugal(_pack_ends(limits, digest)), _SQL)
    out = packed.filter("sequence_id is not null").unionByName(last).drop("_end")
    return out.drop("ids", "loss") if digest else out


def pack(examples: DataFrame, limits: Limits = Limits(), digest: bool = False) -> DataFrame:
    """Pieces of the rows of ``examples`` (example_id, ids, loss) and their places in sequences.

    Columns: example_id, start and length within the example, n_loss,
    example_tokens, sequence_id and offset within the sequence, ids_crc32, and
    without ``digest`` ids and loss mask (null: all of it) of the piece.
    """
    rows = examples.select(F.col("example_id").cast("long"), F.col("ids").cast("array<int>"), F.col("loss").cast("array<boolean>"))
    return _packed(rows, _given, limits, digest)


def pack_documents(
    docs: DataFrame, limits: Limits = Limits(), path: str | None = None, end: int | None = END_ID, digest: bool = False
) -> DataFrame:
    """The same for documents (doc_id, text), encoded and packed in one pass; ``end`` is the id behind each of them."""
    model = Path(path or vocabulary()).read_text(encoding="utf-8")
    return _packed(docs.select(F.col("doc_id").cast("long"), "text"), _encoded(model, end), limits, digest)


def op12_dot_product_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), digest=True)
    return pieces.withColumnsRenamed({"example_id": "doc_id", "example_tokens": "doc_tokens"})
