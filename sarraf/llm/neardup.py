"""Near-duplicate documents with an LSH forest over MinHash signatures.

A document is its set of distinct word shingles.  Documents with equal sets are
one class, found by a fingerprint of the set, and one document of each class
goes on.  Its signature has ``TREES * DEPTH`` minima; tree ``t`` orders the
documents by the signature rotated to start at minimum ``t * DEPTH``.  In each
order, documents that share the longest prefixes stand together: the regions of
a tree are the documents with a common prefix of ``DEPTH`` minima.  Documents of
one region are candidates if their signatures agree on enough minima; candidates
are confirmed on the full sets.

A region of over ``REGION`` documents is first divided by longer prefixes until
it is not, which joins most of what is close at little cost.  Then it is taken
whole: as long as its documents are in several components, those outside its
largest component are compared with all others, in pairs of blocks, so every two
documents of a region have been compared or are in one component.  The trees
take turns at that, since what one tree joins the next need not compare.

Candidates of a crowded region are not listed pair by pair: each document is
paired with the smallest similar one first.  When the confirmed links have been
joined to components, a crowded region whose documents are in several of them is
compared once more, now on the full sets and all with all inside the task, so no
link between components is left out; it gives one edge per document.
Documents with equal signatures beyond the region size are paired with the
smallest of them.

Nulls: a null, empty or wordless text is a class of its own per row and linked
with nothing; a null doc_id is never linked.  Rows with the same doc_id are one
document of two texts: classes with the same smallest doc_id are one.  Repeated rows
share their component.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sarraf.llm.common import compact, discard, frugal, same, shuffle_tasks, stored, table
from sarraf.llm.components import components, smallest_reachable

WORDS = 5
PERCENT = 80
TREES = 20
DEPTH = 4
SIGNATURE = TREES * DEPTH
#: Documents that are compared in one task: of a region, or of two blocks of a crowded one.
REGION = 1024
#: Sets, or pairs of them, that a task reads.
SETS = 4000
#: Regions up to this size list all their candidates.
SMALL = 6
#: Prefix lengths a crowded region is divided by at first, one after the other.
DEPTHS = (6, 9, 13, 20, 40, SIGNATURE)
#: Share of minima that candidates agree on: 4 standard deviations below 0.8.
AGREE = int(SIGNATURE * (0.8 - 4 * (0.8 * 0.2 / SIGNATURE) ** 0.5))
#: Document ids that may be broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000

_U = np.uint64
_DRAW = np.random.default_rng(20240601)
_FACTORS = _DRAW.integers(1, 2**63, SIGNATURE, dtype=np.uint64) * _U(2) + _U(1)
_SHIFTS = _DRAW.integers(0, 2**63, SIGNATURE, dtype=np.uint64)
_PLACES = _DRAW.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)


class _WordHashes(dict):
    """64-bit hash of each word; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    ids = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += ids[k : k + n] * _PLACES[k]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of ``SIGNATURE`` hash functions."""
    least = np.full(SIGNATURE, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, bytes_, keys = [], [], [], []
            for text in batch.column("text"):
                own = shingle_set(text.as_py(), width)
                sizes.append(len(own))
                if not len(own):
                    prints.append(None), bytes_.append(None), keys.append(None)
                    continue
                least = signature(own)
                prints.append(xxhash.xxh128_digest(own.tobytes()))
                bytes_.append((_mixed(least) >> _U(56)).astype(np.uint8).tobytes())
                parts = least.reshape(TREES, DEPTH)
                keys.append([xxhash.xxh64_intdigest(p.tobytes()) - (1 << 63) for p in parts])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                    pa.array(bytes_, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_print", "sig", "keys"],
            )

    return run


def _similar(sig: np.ndarray, n: np.ndarray, a: slice, percent: int) -> np.ndarray:
    agree = (sig[a, None, :] == sig[None, :, :]).sum(axis=2, dtype=np.uint8)
    low, high = np.minimum(n[a, None], n[None, :]), np.maximum(n[a, None], n[None, :])
    return (agree >= AGREE) & (100 * low >= percent * high)


def _region_pairs(doc: np.ndarray, n: np.ndarray, sig: np.ndarray, percent: int):
    """Candidate pairs (a, b) of one region; whether pairs were held back."""
    order = np.argsort(doc, kind="stable")
    doc, n, sig = doc[order], n[order], sig[order]
    found_a, found_b, held = [], [], False
    step = max(1, (1 << 22) // (len(doc) * SIGNATURE) + 1)
    for at in range(0, len(doc), step):
        rows = slice(at, min(at + step, len(doc)))
        like = _similar(sig, n, rows, percent)
        like &= np.arange(len(doc))[None, :] < np.arange(at, rows.stop)[:, None]
        if len(doc) > SMALL:
            held = held or bool((like.sum(axis=1) > 1).any())
            first = like.argmax(axis=1)
            only = np.zeros_like(like)
            only[np.arange(len(first)), first] = True
            like &= only
        i, j = np.nonzero(like)
        found_a.append(doc[j])
        found_b.append(doc[i + at])
    return np.concatenate(found_a), np.concatenate(found_b), held


def _by_region(answer):
    """Calls ``answer`` with all rows of each region; rows are sorted by region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            regions = batch.column("region").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(regions)) + 1), batch.num_rows]
            for x, y in zip(edges, edges[1:], strict=False):
                if x == y:
                    continue
                if held and regions[x] != key:
                    yield from answer(pa.Table.from_batches(held))
                    held.clear()
                key = regions[x]
                held.append(batch.slice(x, y - x))
        if held:
            yield from answer(pa.Table.from_batches(held))

    return run


def _candidates(percent: int):
    """Pairs of each region; of regions that hold pairs back, the members as well."""

    def answer(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        if whole.num_rows < 2:
            return
        doc = whole.column("doc").to_numpy()
        sig = np.frombuffer(b"".join(whole.column("sig").to_pylist()), np.uint8).reshape(-1, SIGNATURE)
        a, b, more = _region_pairs(doc, whole.column("n").to_numpy(), sig, percent)
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none], ["a", "b", "region", "doc"])
        if more:
            none = pa.nulls(len(doc), pa.int64())
            columns = [whole.column(c).combine_chunks() for c in ("region", "doc")]
            yield pa.RecordBatch.from_arrays([none, none, *columns], ["a", "b", "region", "doc"])

    return _by_region(answer)


def _across(percent: int):
    """Pairs between components within a block or across two: for each document the candidate that agrees most.

    Of the others, that are held back, the documents as well.
    """

    def answer(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        doc, comp = whole.column("doc").to_numpy(), whole.column("component").to_numpy()
        n, side = whole.column("n").to_numpy(), whole.column("side").to_numpy()
        sig = np.frombuffer(b"".join(whole.column("sig").to_pylist()), np.uint8).reshape(-1, SIGNATURE)
        left = right = np.arange(len(doc))
        if whole.column("across")[0].as_py():
            left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side != side.min())
        if not len(right):
            return
        step = max(1, (1 << 22) // (len(right) * SIGNATURE) + 1)
        agree = np.concatenate([
            (sig[left[at : at + step], None, :] == sig[right][None, :, :]).sum(axis=2, dtype=np.uint8)
            for at in range(0, len(left), step)
        ])
        low, high = np.minimum(n[left, None], n[right]), np.maximum(n[left, None], n[right])
        like = (agree >= AGREE) & (100 * low >= percent * high) & (comp[left, None] != comp[right])
        agree = np.where(like, agree, 0)
        i, j = np.flatnonzero(like.any(axis=1)), np.flatnonzero(like.any(axis=0))
        x, y = np.concatenate([i, agree[:, j].argmax(axis=0)]), np.concatenate([agree[i].argmax(axis=1), j])
        like[x, y] = False
        one, two = doc[left[x]], doc[right[y]]
        none = pa.nulls(len(one), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), none, none], ["a", "b", "region", "doc"]
        )
        held = pa.array(np.union1d(left[like.any(axis=1)], right[like.any(axis=0)]), pa.int64())
        none = pa.nulls(len(held), pa.int64())
        columns = [whole.column(c).combine_chunks().take(held) for c in ("region", "doc")]
        yield pa.RecordBatch.from_arrays([none, none, *columns], ["a", "b", "region", "doc"])

    return _by_region(answer)


def _common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, item, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    several = times[item] > 1
    owner, item = owner[several], number[item[several]]
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    common = np.zeros((len(sets), len(sets)), np.int64)
    for at in range(0, int(item[-1]) + 1 if len(item) else 0, 4096):
        x, y = np.searchsorted(item, [at, at + 4096])
        held = np.zeros((len(sets), 4096), np.float32)
        held[owner[x:y], item[x:y] - at] = 1
        common += (held @ held.T).astype(np.int64)
    return common


def _crowd_links(percent: int):
    """Edges between documents of different components that a region links, one per document."""

    def answer(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        doc, comp = whole.column("doc").to_numpy(), whole.column("component").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in whole.column("shingles").to_pylist()]
        n = np.array([len(x) for x in sets])
        common = _common_counts(sets)
        links = (100 * common >= percent * (n[:, None] + n[None, :] - common)) & (comp[:, None] != comp[None, :])
        label = smallest_reachable(links, doc)
        some = label != doc
        yield pa.RecordBatch.from_arrays([pa.array(label[some]), pa.array(doc[some])], ["a", "b"])

    return _by_region(answer)


def _compared(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(chosen), batch.column("b").filter(chosen)], ["a", "b"]
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(t.as_py(), width) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([xxhash.xxh128_digest(x.tobytes()) for x in own], pa.binary()),
                    pa.array([x.tobytes() for x in own], pa.binary()),
                ],
                ["id", "set_print", "shingles"],
            )

    return run


def _sets_of(docs: DataFrame, classes: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, shingles) of the classes named in ``ids`` (_id); only their documents are read into sets."""
    n = ids.count()
    few = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    texts = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("_id"), "left_semi")
    sets = texts.mapInArrow(frugal(_sets(width)), "id long, set_print binary, shingles binary")
    # A document of two texts has two sets: the one of its class counts.
    own = classes.select(F.col("rep").alias("_rep"), F.col("set_print").alias("_print"))
    own = own.join(few, F.col("_rep") == F.col("_id"), "left_semi")
    sets = sets.join(own, (F.col("id") == F.col("_rep")) & (F.col("set_print") == F.col("_print")))
    return stored(compact(sets.select("id", "shingles").dropDuplicates(["id"]), n, SETS), "near-sets")


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    The pairs meet the sets in two joins that Spark splits where a document has very many pairs.
    """
    n = pairs.count()
    ids = pairs.select(F.explode(F.array("a", "b")).alias("_id")).groupBy("_id").agg(F.lit(1).alias("_1")).drop("_1")
    ids = stored(compact(ids, 2 * n), "near-ids")
    sets = _sets_of(docs, classes, ids, width)
    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
    out = stored(compact(two, n, SETS).mapInArrow(frugal(_compared(percent)), "a long, b long"), "near-links")
    discard(ids, sets)
    return out


def _linked_crowds(
    docs: DataFrame, classes: DataFrame, crowds: DataFrame, comps: DataFrame, width: int, percent: int
) -> DataFrame | None:
    """Edges (a, b) that crowded regions (region, doc) add to the components."""
    named = crowds.join(comps, F.col("doc") == F.col("node"), "left").select(
        "region", "doc", F.coalesce("component", "doc").alias("component")
    )
    named = stored(named, "near-crowds")
    split = named.groupBy(F.col("region").alias("_region")).agg(
        F.min("component").alias("_low"), F.max("component").alias("_high")
    ).filter("_low <> _high").select("_region")
    split = stored(named.join(split, F.col("region") == F.col("_region"), "left_semi"), "near-split")
    ids = split.select(F.col("doc").alias("_id")).groupBy("_id").agg(F.lit(1).alias("_1")).drop("_1")
    ids = stored(compact(ids, split.count()), "near-ids")
    if ids.isEmpty():
        return None
    sets = _sets_of(docs, classes, ids, width)
    rows = split.join(sets, F.col("doc") == F.col("id")).select("region", "doc", "component", "shingles")
    rows = rows.repartition(shuffle_tasks(docs.sparkSession), "region").sortWithinPartitions("region")
    return stored(rows.mapInArrow(frugal(_crowd_links(percent)), "a long, b long"), "near-links")


def _region(tree: Column, depth: int) -> Column:
    """Region at a longer prefix of the rotated signature."""
    turned = F.concat(F.expr(f"substring(sig, tree * {DEPTH} + 1, {SIGNATURE})"), F.expr(f"substring(sig, 1, tree * {DEPTH})"))
    return F.xxhash64("region", F.substring(turned, DEPTH + 1, depth - DEPTH))


def forest(classes: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(rows, stars, whole): rows (region, doc, n, sig) of all trees, pairs (a, b) of documents with one signature.

    ``whole`` has the rows of the crowded regions as they were before they were divided, with their tree.
    """
    rows = classes.select(
        F.col("rep").alias("doc"), F.col("n_shingles").alias("n"), "sig", F.posexplode("keys").alias("tree", "_key")
    ).select("doc", "n", "sig", "tree", F.xxhash64("tree", "_key").alias("region"))
    stars = whole = None
    for depth in DEPTHS:
        sizes = rows.groupBy(F.col("region").alias("_region")).agg(F.count("*").alias("_n"), F.min("doc").alias("_least"))
        crowded = stored(sizes.filter(F.col("_n") > REGION), "near-crowded")
        if crowded.isEmpty():
            discard(crowded)
            break
        if whole is None:
            own = rows.join(crowded, F.col("region") == F.col("_region"), "left_semi")
            whole = stored(own.select("region", "doc", "n", "sig", "tree"), "near-whole")
        met = rows.join(crowded, F.col("region") == F.col("_region"), "left")
        deeper = F.when(F.col("_region").isNull(), F.col("region")).otherwise(_region(F.col("tree"), depth))
        rows = met.select("doc", "n", "sig", "tree", deeper.alias("region"))
    else:
        sizes = rows.groupBy(F.col("region").alias("_region")).agg(F.count("*").alias("_n"), F.min("doc").alias("_least"))
        crowded = stored(sizes.filter(F.col("_n") > REGION), "near-crowded")
        met = rows.join(crowded, F.col("region") == F.col("_region"), "left")
        stars = met.filter("_region is not null and doc <> _least").select(F.col("_least").alias("a"), F.col("doc").alias("b"))
        rows = met.filter("_region is null").select("doc", "n", "sig", "tree", "region")
    return rows.select("region", "doc", "n", "sig"), stars, whole


def _blocks(whole: DataFrame, comps: DataFrame) -> DataFrame | None:
    """Regions with several components as pairs of blocks; pairs within the largest component are left out."""
    named = whole.join(comps, F.col("doc") == F.col("node"), "left").select(
        "region", "doc", "n", "sig", F.coalesce("component", "doc").alias("component")
    )
    named = stored(named, "near-whole")
    sizes = named.groupBy("region", "component").agg(F.count("*").alias("_n"))
    block = F.lit(max(1, REGION // 2))
    split = stored(
        sizes.groupBy(F.col("region").alias("_region"))
        .agg(F.max(F.struct("_n", "component")).alias("_m"), F.sum("_n").alias("_all"))
        .filter("_m._n < _all")
        .select(
            "_region", F.col("_m.component").alias("_main"), F.ceil(F.col("_m._n") / block).alias("_big"),
            F.ceil((F.col("_all") - F.col("_m._n")) / block).alias("_rest"),
        ),
        "near-split",
    )
    if split.isEmpty():
        discard(named, split)
        return None
    met = named.join(split, F.col("region") == F.col("_region")).withColumn("_h", F.xxhash64("doc", "region"))
    main = F.col("component") == F.col("_main")
    met = met.withColumns({
        "side": F.when(main, F.pmod("_h", "_big")).otherwise(F.col("_big") + F.pmod("_h", "_rest")),
        "_from": F.when(main, F.col("_big")).otherwise(F.lit(0).cast("long")),
    })
    other = F.explode(F.sequence(F.col("_from"), F.col("_big") + F.col("_rest") - 1)).alias("_other")
    return met.select("region", "doc", "n", "sig", "component", "side", other).select(
        F.xxhash64("region", F.least("side", "_other"), F.greatest("side", "_other")).alias("region"),
        "doc", "n", "sig", "component", "side", (F.col("side") != F.col("_other")).alias("across"),
    )


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) with further links (a, b)."""
    if links.isEmpty():
        return comps
    known = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return stored(components(known.union(links.select("a", "b"))), "near-components")


def _compared_whole(
    docs: DataFrame, classes: DataFrame, whole: DataFrame, comps: DataFrame, width: int, percent: int
) -> DataFrame:
    """The components when all documents of crowded regions have been compared with all."""
    dealt = _blocks(whole, comps)
    if dealt is None:
        return comps
    dealt = dealt.repartition(shuffle_tasks(docs.sparkSession), "region").sortWithinPartitions("region")
    found = stored(dealt.mapInArrow(frugal(_across(percent)), _CANDIDATE), "near-found")
    pairs = found.filter("a is not null").select("a", "b")
    pairs = stored(compact(pairs.distinct(), pairs.count()), "near-pairs")
    if pairs.isEmpty():
        return comps
    comps = _joined(comps, _confirmed(docs, classes, pairs, width, percent))
    crowds = found.filter("a is null").select("region", "doc")
    if not crowds.isEmpty():
        more = _linked_crowds(docs, classes, crowds, comps, width, percent)
        if more is not None:
            comps = _joined(comps, more)
    return comps


_CANDIDATE = "a long, b long, region long, doc long"


def near_duplicates(docs: DataFrame, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs`` (doc_id, text)."""
    signed = stored(
        docs.select("doc_id", "text").mapInArrow(
            frugal(_sign(width)), "doc_id long, n_shingles long, set_print binary, sig binary, keys array<long>"
        ),
        "near-signed",
    )
    classes = stored(
        signed.filter("set_print is not null and doc_id is not null").groupBy("set_print").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"),
            F.first("keys").alias("keys"),
        ),
        "near-classes",
    )
    rows, stars, whole = forest(classes)
    tasks = shuffle_tasks(docs.sparkSession)
    sorted_rows = rows.repartition(tasks, "region").sortWithinPartitions("region")
    found = stored(sorted_rows.mapInArrow(frugal(_candidates(percent)), _CANDIDATE), "near-found")
    pairs = found.filter("a is not null").select("a", "b")
    pairs = pairs.union(stars) if stars is not None else pairs
    pairs = stored(compact(pairs.distinct(), pairs.count()), "near-pairs")
    links = _confirmed(docs, classes, pairs, width, percent)
    comps = stored(components(links), "near-components")
    crowds = found.filter("a is null").select("region", "doc")
    if not crowds.isEmpty():
        more = _linked_crowds(docs, classes, crowds, comps, width, percent)
        if more is not None:
            comps = _joined(comps, more)
    if whole is not None:
        comps = _compared_whole(docs, classes, whole, comps, width, percent)
    named = stored(
        classes.select("set_print", "rep").join(comps, F.col("rep") == F.col("node"), "left").select(
            F.col("set_print").alias("_print"), F.coalesce("component", "rep").alias("_component")
        ),
        "near-named",
    )
    out = signed.select("doc_id", "n_shingles", "set_print").join(
        named, F.col("set_print") == F.col("_print"), "left"
    )
    known = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id", "n_shingles", F.when(known, F.coalesce("_component", "doc_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest doc_id; rows without id or words all stay.

    Rows that share the id and are near duplicates are reduced to one.
    """
    named = near_duplicates(docs, **options)
    gone = stored(
        named.filter("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct(), "near-gone"
    )
    return docs.join(gone, F.col("doc_id") == F.col("_id"), "left_anti")


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), width=4)
    return out.withColumn("kept", same(F.col("doc_id"), F.col("component_id")))


OP2_SQL = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM word
), item AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS met
  FROM item x JOIN item y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), link AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * met >= 80 * (na + nb - met)),
either AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reach r JOIN either e ON r.b = e.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.a
"""
