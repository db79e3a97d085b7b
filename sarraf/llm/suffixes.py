"""Removal of long byte strings that an earlier document holds, by sparse suffix runs and LCP merging.

A byte is removed if some string of ``LENGTH`` bytes over it also starts in a
document with a smaller doc_id.  Of all suffixes only those at anchors are
sorted: the anchor of a string is the place of its smallest ``GRAM``-gram hash (the leftmost
of equals), so equal strings have equal anchors at equal distance, and an
anchor stands for all strings around it.  Nothing is lost by this: every string
has an anchor, and strings are compared byte by byte in the end.

1. Documents are packed into segments.
2. Grams of anchors go, as sorted runs of numbers per segment, to the range of their
   hash; those that other documents hold too come back marked.
3. Suffixes at marked anchors become runs per segment and hash range: sorted,
   each with its common prefix with the one before left out (front coding), and
   the bytes to the left that its strings reach back to.  A task merges the runs of a
   range with a loser tree that keeps the common prefix with the last winner
   of every run, so known prefixes are not compared again.  Suffixes with a
   common gram come out together, and their strings are matched there.
4. The answers go back to the segments, which cut the documents.

Equal contexts of a segment travel once, with the smallest doc_id.  A gram with
over ``HOT`` different contexts (the edge of a very frequent passage) is dealt
by whole strings instead of by gram, so no group grows with the corpus.

A null or empty text has no bytes.  A null doc_id counts as larger than all
others; documents with the same doc_id do not remove from each other.  Repeated
rows are cut alike.  Empty tables give no rows; other columns are ignored.
Texts are never cut short; segments have ``SEGMENT_BYTES`` and one document at most.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.llm.common import shuffle_tasks, stored, table

LENGTH = 50
GRAM = 26
SPAN = LENGTH - GRAM + 1
SEGMENT_BYTES = 4 << 20
#: Strings looked at in one numpy step.
PART = 1 << 20
#: Anchors of a hash range, suffixes of a merge, contexts of a gram that is still one group.
RANGE_ANCHORS = 1_000_000
MERGE_SUFFIXES = 100_000
HOT = 5_000
NO_ID = 2**63 - 1

_U = np.uint64
_DRAW = np.random.default_rng(77)
_BYTES = _DRAW.integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _DRAW.integers(0, 2, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(PART + LENGTH + 1, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x, done = np.minimum(x[:-done], x[done:]), done * 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


class Anchors:
    """Anchors of a segment: place, first and last string they stand for, document, gram and context hashes."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray):
        forward, back = _power_tables()
        last = np.repeat(ends, np.diff(ends, prepend=0)) if len(ends) else ends
        found: list[tuple[np.ndarray, ...]] = []
        for at in range(0, len(raw) - LENGTH + 1, PART):
            n = min(PART, len(raw) - LENGTH + 1 - at)
            sums = np.zeros(n + LENGTH, np.uint64)
            np.cumsum(_BYTES[raw[at : at + n + LENGTH - 1]] * forward[: n + LENGTH - 1], out=sums[1:])
            grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * back[: len(sums) - GRAM])
            low = _U((1 << 22) - 1)
            order = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
            place = (_sliding_min(order, SPAN)[:n] & low).astype(np.int64)
            place[last[at : at + n] < np.arange(at + LENGTH, at + LENGTH + n)] = -1  # strings over the end of a document
            edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            stop = np.append(edge[1:], n) - 1
            real = place[edge] >= 0
            lo, hi = edge[real], stop[real]
            p = place[lo]
            whole = (sums[hi + LENGTH] - sums[lo]) * back[lo]
            ctx = _mixed(whole + (hi - lo).astype(np.uint64) * _U(0xA24BAED4963EE407) + (p - lo).astype(np.uint64) * _U(0x9FB21C651E98DF25))
            found.append((p + at, lo + at, hi + at, grams[p], ctx))
        columns = zip(*found, strict=True) if found else [[np.empty(0, t)] for t in (int, int, int, np.uint64, np.uint64)]
        self.place, self.lo, self.hi, self.gram, self.ctx = (np.concatenate(c) for c in columns)
        self.doc = np.searchsorted(ends, self.place, side="right")


def _pack(value) -> bytes:
    return zstandard.compress(pickle.dumps(value, 5), 1)


def _unpack(raw: bytes):
    return pickle.loads(zstandard.decompress(raw))


# --- segments ---------------------------------------------------------------------

_SEGMENT = pa.schema([("seg", pa.int64()), ("ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("data", pa.binary())])
_SEGMENT_SQL = "seg long, ids array<long>, ends array<long>, data binary"


def _segments(segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = TaskContext.get().partitionId() << 24
        ids, texts, held = [], [], 0

        def flush():
            ends = np.cumsum([len(t) for t in texts]).tolist()
            row = {"seg": seg, "ids": ids, "ends": ends, "data": zstandard.compress(b"".join(texts), 5)}
            return pa.RecordBatch.from_pylist([row], _SEGMENT)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = (text.as_py() or "").encode()
                ids.append(doc)
                texts.append(raw)
                held += len(raw)
                if held >= segment_bytes:
                    yield flush()
                    seg += 1
                    ids, texts, held = [], [], 0
        if ids:
            yield flush()

    return run


class Segment:
    def __init__(self, row: dict):
        self.ids = row["ids"]
        self.keys = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)
        self.ends = np.array(row["ends"], np.int64)
        self.raw = np.frombuffer(zstandard.decompress(row["data"]), np.uint8)
        self.anchors = Anchors(self.raw, self.ends)


# --- which grams do several documents hold? -------------------------------------------

_ANSWER = pa.schema([("seg", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
_ANSWER_SQL = "seg long, part int, n long, data binary"


def _range_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)


def _kinds(which: np.ndarray, times: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many different values of ``other`` each gram has; only grams at several anchors need a look."""
    out = np.minimum(times, 1)
    own = np.flatnonzero(times[which] > 1)
    if len(own):
        order = own[np.lexsort((other[own], which[own]))]
        w, o = which[order], other[order]
        out += np.bincount(w[1:][(w[1:] == w[:-1]) & (o[1:] != o[:-1])], minlength=len(times))
    return out


def _gram_table(a: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams of a segment, numbers of documents and of contexts per gram."""
    grams, which, times = np.unique(a.gram, return_inverse=True, return_counts=True)
    return grams, _kinds(which, times, a.doc), _kinds(which, times, a.ctx)


def _ask(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams, docs, contexts = _gram_table(Segment(row).anchors)
                part = _range_of(grams, parts)
                cuts = np.searchsorted(part, np.arange(parts + 1))
                for i in range(parts):
                    x, y = cuts[i], cuts[i + 1]
                    if x < y:
                        low = (grams[x:y] * _U(parts) >> _U(32)).astype(np.uint32)  # place in the range
                        data = (np.diff(low, prepend=np.uint32(0)), docs[x:y] > 1, np.minimum(contexts[x:y], 2**31).astype(np.int32))
                        yield pa.RecordBatch.from_pylist(
                            [{"seg": row["seg"], "part": i, "n": int(y - x), "data": _pack(data)}], _ANSWER
                        )

    return run


def _mark(hot: int):
    """0: no other document holds the gram; 1: some do; 2: in very many contexts."""

    def answers(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        asked = [_unpack(r["data"]) for r in rows]
        lows = [np.cumsum(d, dtype=np.uint32) for d, _, _ in asked]
        _, which, times = np.unique(np.concatenate(lows), return_inverse=True, return_counts=True)
        contexts = np.bincount(which, weights=np.concatenate([c for _, _, c in asked]))
        at = 0
        for row, low, (_, several, _) in zip(rows, lows, asked, strict=True):
            own = which[at : at + len(low)]
            at += len(low)
            marks = np.where((times[own] > 1) | several, np.where(contexts[own] > hot, 2, 1), 0).astype(np.uint8)
            yield pa.RecordBatch.from_pylist(
                [{"seg": row["seg"], "part": row["part"], "n": int((marks > 0).sum()), "data": _pack(marks)}], _ANSWER
            )

    return _by_part(answers)


def _by_part(answers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["part"] != rows[0]["part"]:
                    yield from answers(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from answers(rows)

    return run


# --- suffix runs --------------------------------------------------------------------

class Suffixes:
    """Distinct contexts at the marked anchors of a segment, with the anchors they stand for.

    A hot gram has an entry for each of its strings, others one for each context.
    """

    def __init__(self, s: Segment, marks: np.ndarray):
        a = s.anchors
        _, which = np.unique(a.gram, return_inverse=True)
        mark = marks[which] if len(marks) else np.zeros(len(which), np.uint8)
        usual, hot = np.flatnonzero(mark == 1), np.flatnonzero(mark == 2)
        strings = a.hi[hot] - a.lo[hot] + 1
        owner = np.repeat(hot, strings)
        start = a.lo[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
        lo, hi = np.concatenate([a.lo[usual], start]), np.concatenate([a.hi[usual], start])
        anchor = np.concatenate([usual, owner])
        place = a.place[anchor]
        single = np.arange(len(anchor)) >= len(usual)
        raw = np.concatenate([s.raw, np.zeros(LENGTH * 2, np.uint8)])
        # Strings of hot grams are told apart by their bytes, other contexts by their hash.
        key = np.concatenate([a.ctx[usual], _string_hashes(raw, start, place[len(usual) :] - start)])
        _, first, entry = np.unique(key, return_index=True, return_inverse=True)
        self.entry, self.lo, self.hi, self.doc = entry, lo, hi, a.doc[anchor]
        self.least = np.full(len(first), NO_ID, np.int64)
        np.minimum.at(self.least, entry, s.keys[self.doc])
        self.left = place[first] - lo[first]
        self.right = hi[first] + LENGTH - place[first]
        self.place, self.raw = place[first], raw
        self.spread = np.where(single[first], key[first], a.gram[anchor[first]])


def _string_hashes(raw: np.ndarray, start: np.ndarray, offset: np.ndarray) -> np.ndarray:
    forward, _ = _power_tables()
    out = np.zeros(len(start), np.uint64)
    for k in range(LENGTH):
        out += _BYTES[raw[start + k]] * forward[k]
    return _mixed(out + offset.astype(np.uint64) * _U(0x9FB21C651E98DF25))


def _ordered(s: Suffixes, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(range, entries, bytes of their suffixes) with the suffixes of each range in byte order."""
    part = _range_of(s.spread, parts)
    for i in np.unique(part):
        own = np.flatnonzero(part == i)
        grid = s.raw[s.place[own][:, None] + np.arange(56)]
        size = s.right[own]
        grid[np.arange(56)[None, :] >= size[:, None]] = 0
        words = np.ascontiguousarray(grid).view(">u8").astype(np.uint64)
        order = np.lexsort((s.left[own], size, *words.T[::-1]))
        yield int(i), own[order], grid[order]


def _runs(s: Suffixes, parts: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(range, entries, front-coded run) of each range."""
    for i, own, grid in _ordered(s, parts):
        size = s.right[own]
        common = np.zeros(len(own), np.int64)
        if len(own) > 1:
            differ = grid[1:] != grid[:-1]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), 56)
            common[1:] = np.minimum(first, np.minimum(size[1:], size[:-1]))
        at = np.arange(56)[None, :]
        rest = grid[(at >= common[:, None]) & (at < size[:, None])].tobytes()
        left = s.left[own]
        back = s.raw[np.maximum(s.place[own][:, None] - np.arange(SPAN - 1, 0, -1), 0)]
        lead = back[np.arange(SPAN - 1, 0, -1)[None, :] <= left[:, None]].tobytes()
        yield i, own, _pack((
            common.astype(np.uint8), size.astype(np.uint8), rest, left.astype(np.uint8), lead, s.least[own]
        ))


class Run:
    """Reads a front-coded run: the current suffix and its common prefix with the one before."""

    __slots__ = ("common", "size", "rest", "left", "lead", "doc", "n", "i", "text", "at", "lead_at")

    def __init__(self, raw: bytes):
        common, size, self.rest, left, self.lead, doc = _unpack(raw)
        self.common, self.size, self.left, self.doc = common.tolist(), size.tolist(), left.tolist(), doc.tolist()
        self.n, self.i, self.text, self.at, self.lead_at = len(size), -1, b"", 0, 0

    def step(self) -> bool:
        if self.i >= 0:
            self.lead_at += self.left[self.i]
        self.i += 1
        if self.i == self.n:
            return False
        keep = self.common[self.i]
        stop = self.at + self.size[self.i] - keep
        self.text = self.text[:keep] + self.rest[self.at : stop]
        self.at = stop
        return True

    def before(self) -> bytes:
        return self.lead[self.lead_at : self.lead_at + self.left[self.i]]


def merged(runs: list[Run]) -> Iterator[tuple[int, int]]:
    """(number of the run, common prefix with the last one) of each suffix in byte order; the suffix is the run's current one.

    A loser tree whose nodes keep the common prefix of the loser with the last
    winner that passed.  Of two candidates the one with the longer common
    prefix with the last winner is smaller; only if they are equal, bytes behind it are
    compared.
    """
    width = 1
    while width < len(runs):
        width *= 2
    done = len(runs)  # number of a run that has ended
    texts: list[bytes | None] = [r.text if r.step() else None for r in runs]
    losers, shared = [done] * width, [0] * width

    def play(a: int, ha: int, b: int, hb: int) -> tuple[int, int, int, int]:
        """winner, its prefix, loser, its prefix with the winner."""
        if b == done or texts[b] is None:
            return a, ha, done, 0
        if a == done or texts[a] is None:
            return b, hb, done, 0
        if ha > hb:
            return a, ha, b, hb
        if hb > ha:
            return b, hb, a, ha
        x, y, h = texts[a], texts[b], ha
        if x == y:
            return (a, ha, b, len(x)) if a < b else (b, hb, a, len(x))
        stop = min(len(x), len(y))
        while h < stop and x[h] == y[h]:
            h += 1
        less = h == len(x) or (h < len(y) and x[h] < y[h])
        return (a, ha, b, h) if less else (b, hb, a, h)

    def build(node: int) -> tuple[int, int]:
        if node >= width:
            leaf = node - width
            return (leaf if leaf < len(runs) else done), 0
        a, b = build(2 * node), build(2 * node + 1)
        winner, h, losers[node], shared[node] = play(*a, *b)
        return winner, h

    best, h = build(1)
    while best != done and texts[best] is not None:
        yield best, h
        run = runs[best]
        if run.step():
            texts[best], h = run.text, run.common[run.i]
        else:
            texts[best], h = None, 0
        node, cur = (best + width) // 2, best
        while node:
            cur, h, losers[node], shared[node] = play(cur, h, losers[node], shared[node])
            node //= 2
        best = cur


def _matched(group: list[tuple[int, int, bytes, bytes, int]], masks: list[np.ndarray]) -> None:
    """Strings of each suffix of one gram that a smaller document holds, as bits from the first string."""
    contexts: dict[tuple[bytes, bytes], int] = {}
    for _, _, left, right, doc in group:
        known = contexts.get((left, right))
        if known is None or doc < known:
            contexts[left, right] = doc
    strings: dict[tuple[int, bytes], int] = {}
    if len(contexts) > 1:
        for (left, right), doc in contexts.items():
            whole, offset = left + right, len(left)
            for k in range(len(whole) - LENGTH + 1):
                key = offset - k, whole[k : k + LENGTH]
                known = strings.get(key)
                if known is None or doc < known:
                    strings[key] = doc
    for run, i, left, right, doc in group:
        whole, offset = left + right, len(left)
        if doc > contexts[left, right]:
            masks[run][i] = (1 << (len(whole) - LENGTH + 1)) - 1
        elif strings:
            found = (strings[offset - k, whole[k : k + LENGTH]] < doc for k in range(len(whole) - LENGTH + 1))
            masks[run][i] = sum(1 << k for k, smaller in enumerate(found) if smaller)


def _merge(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    runs = [Run(r["data"]) for r in rows]
    masks = [np.zeros(r.n, np.uint32) for r in runs]
    group: list[tuple[int, int, bytes, bytes, int]] = []

    for number, common in merged(runs):
        if common < GRAM:
            if len(group) > 1:
                _matched(group, masks)
            group = []
        run = runs[number]
        group.append((number, run.i, run.before(), run.text, run.doc[run.i]))
    if len(group) > 1:
        _matched(group, masks)
    for row, mask in zip(rows, masks, strict=True):
        yield pa.RecordBatch.from_pylist(
            [{"seg": row["seg"], "part": row["part"], "n": int((mask > 0).sum()), "data": _pack(mask)}], _ANSWER
        )


# --- back in the segments ---------------------------------------------------------------

def _by_segment(work):
    """Answers come before the segment they belong to; parts in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: dict[str, list[dict]] = {"marks": [], "masks": []}
        seg = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["seg"] != seg:
                    seg, answers = row["seg"], {"marks": [], "masks": []}
                if row["kind"] == "text":
                    yield from work(row, answers)
                else:
                    answers[row["kind"]].append(row)

    return run


def _marks(answers: list[dict]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint8), *(_unpack(a["data"]) for a in answers)])


def _suffix_runs(parts: int):
    def work(row: dict, answers: dict) -> Iterator[pa.RecordBatch]:
        if any(a["n"] for a in answers["marks"]):
            found = Suffixes(Segment(row), _marks(answers["marks"]))
            for part, own, data in _runs(found, parts):
                yield pa.RecordBatch.from_pylist([{"seg": row["seg"], "part": part, "n": len(own), "data": data}], _ANSWER)

    return _by_segment(work)


_CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("stops", pa.list_(pa.int64())), ("kept", pa.binary())])
_CUT_SQL = "doc_id long, n_bytes long, starts array<long>, stops array<long>, kept binary"


def _removed(found: Suffixes, keys: np.ndarray, masks: np.ndarray, n: int) -> np.ndarray:
    """Which of the ``n`` bytes of a segment go."""
    later = keys[found.doc] > found.least[found.entry]
    mask = np.where(later, np.uint32(0xFFFFFFFF), masks[found.entry])
    own = np.flatnonzero(mask)
    mask, lo, strings = mask[own], found.lo[own], found.hi[own] - found.lo[own] + 1
    starts = np.zeros(n + LENGTH, np.int8)  # a string has one anchor
    for k in range(SPAN):
        starts[lo[((mask >> np.uint32(k)) & np.uint32(1)).astype(bool) & (k < strings)] + k] = 1
    before = np.cumsum(starts[:n], dtype=np.int32)
    gone = before > 0
    gone[LENGTH:] = before[LENGTH:] > before[:-LENGTH]
    return gone


def _cut(parts: int):
    def work(row: dict, answers: dict) -> Iterator[pa.RecordBatch]:
        s = Segment(row)
        gone = np.zeros(len(s.raw), bool)
        if answers["masks"]:
            found = Suffixes(s, _marks(answers["marks"]))
            masks = np.zeros(len(found.least), np.uint32)
            bits = {a["part"]: _unpack(a["data"]) for a in answers["masks"]}
            for part, own, _ in _ordered(found, parts):
                masks[own] = bits[part]
            gone = _removed(found, s.keys, masks, len(s.raw))
        begins = np.concatenate([[0], s.ends[:-1]]) if len(s.ends) else s.ends
        # Edges of removed runs, which end with their document.
        edge = np.zeros(len(gone) + 1, bool)
        edge[begins] = edge[s.ends] = True
        same = ~edge[1:-1]
        first, last = gone.copy(), gone.copy()
        first[1:] &= ~(gone[:-1] & same)
        last[:-1] &= ~(gone[1:] & same)
        starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        of_doc = np.searchsorted(starts, [begins, s.ends])
        raw, rows = s.raw.tobytes(), []
        for doc, x, y, i, j in zip(s.ids, begins.tolist(), s.ends.tolist(), *of_doc.tolist(), strict=True):
            keep = [x, *np.column_stack([starts[i:j], stops[i:j]]).ravel().tolist(), y] if i < j else [x, y]
            rows.append({
                "doc_id": doc, "n_bytes": y - x, "starts": starts[i:j] - x, "stops": stops[i:j] - x,
                "kept": b"".join(raw[a:b] for a, b in zip(keep[::2], keep[1::2], strict=True)),
            })
        for at in range(0, len(rows), 500):
            yield pa.RecordBatch.from_pylist(rows[at : at + 500], _CUT)

    return _by_segment(work)


def _with_answers(segments: DataFrame, marks: DataFrame, masks: DataFrame | None) -> DataFrame:
    """Rows of each segment together: marks, then masks, then the text."""
    none = {"ids": F.lit(None).cast("array<long>"), "ends": F.lit(None).cast("array<long>")}
    rows = segments.withColumns({"kind": F.lit("text"), "part": F.lit(0), "n": F.lit(0).cast("long")})
    for kind, answers in (("marks", marks), ("masks", masks)):
        if answers is not None:
            rows = rows.unionByName(answers.withColumns({"kind": F.lit(kind), **none}))
    tasks = shuffle_tasks(segments.sparkSession)
    return rows.repartition(tasks, "seg").sortWithinPartitions("seg", "kind", "part")


def cut_repeats(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """doc_id, n_bytes, removed byte ranges (starts, stops) and kept bytes of every row of ``docs`` (doc_id, text)."""
    tasks = shuffle_tasks(docs.sparkSession)
    segments = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_segments(segment_bytes), _SEGMENT_SQL), "suffix-segments"
    )
    size = segments.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    parts = max(1, -(-2 * size // (SPAN * RANGE_ANCHORS)))
    asked = segments.mapInArrow(_ask(parts), _ANSWER_SQL)
    asked = asked.repartition(tasks, "part").sortWithinPartitions("part", "seg")
    marks = stored(asked.mapInArrow(_mark(HOT), _ANSWER_SQL), "suffix-marks")
    marked = marks.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-marked // MERGE_SUFFIXES))
    runs = _with_answers(segments, marks, None).mapInArrow(_suffix_runs(ranges), _ANSWER_SQL)
    runs = runs.repartition(tasks, "part").sortWithinPartitions("part", "seg")
    masks = stored(runs.mapInArrow(_by_part(_merge), _ANSWER_SQL), "suffix-masks")
    return _with_answers(segments, marks, masks).mapInArrow(_cut(ranges), _CUT_SQL)


def op7_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cut_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("starts", "stops", lambda a, b: b - a), F.lit(0).cast("long"), lambda t, x: t + x)
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
