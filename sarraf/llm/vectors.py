"""Near-duplicate vectors with iterative quantisation and multi-index Hamming tables.

Vectors are scaled to length 1 and equal ones become one class.  Iterative
quantisation learns, on a bounded sample, rotations under which the signs of a
centred vector (against the median of each direction) are balanced bits that
lose little.  The codes are cut into substrings; each substring of each rotation is
one Hamming table.  Vectors that share a substring are candidates, and a task
reranks the candidates of a bucket with the original vectors in double
precision, as one matrix product per pair of blocks.

The length of the substrings follows the number of vectors, so buckets keep
their size; the number of tables follows from the length, so that a pair at the
threshold is missed in all tables with probability ``MISS`` at most.  A pair that shares
several substrings counts in the first of them only, so link counts add up
without listing pairs: a bucket gives one count and one connecting edge per
vector.  Buckets over ``BLOCK`` vectors are dealt as pairs of blocks.

Vectors of different lengths have an index of their own for each length, one
after the other.  Vectors that are null, zero or hold nulls or non-finite
components link with nothing, as do vectors without vec_id.
Repeated rows are vectors of their own and link with each other.  Empty tables
give no rows; other columns, labels too, are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.llm.common import same, shuffle_tasks, stored, table
from sarraf.llm.components import components, smallest_reachable

COSINE = 0.9
#: Vectors the rotations are learned on; all vectors are indexed.
SAMPLE = 8192
ROUNDS = 12
MISS = 1e-3
#: Length of the mean of the sample up to which vectors are centred.
CENTRED = 0.35
#: Vectors of a bucket on average.
BUCKET = 32
#: Vectors compared with each other in one step.
BLOCK = 1024


def learn_rotation(sample: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Rotation that brings centred vectors close to the corners of the cube, from a random start."""
    d = sample.shape[1]
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    for _ in range(rounds):
        turned = sample @ turn
        codes = np.where(turned >= np.median(turned, axis=0), 1.0, -1.0)
        u, _, vt = np.linalg.svd(sample.T @ codes)
        turn = u @ vt
    return turn


class Index:
    """Rotations, thresholds and the cut into tables.

    Vectors are centred and cut at medians unless their mean is so long that
    this would part close vectors; then the signs themselves are the bits.  The
    number of tables allows for what centring does to the angle of a pair at
    the threshold in the worst direction, that of the mean.
    """

    def __init__(self, sample: np.ndarray, n: int, cosine: float, seed: int = 5):
        d = sample.shape[1]
        self.bits = max(1, min(d, 30, math.ceil(math.log2(max(n, 2) / BUCKET))))
        mean = sample.mean(axis=0)
        long = float(np.linalg.norm(mean))
        centre = long <= CENTRED
        self.mean = mean if centre else np.zeros(d)
        seen = (cosine - 2 * long + long**2) / (1 - 2 * long + long**2) if centre else cosine
        miss = 1 - (1 - math.acos(seen) / math.pi) ** self.bits
        wanted = math.ceil(math.log(MISS) / math.log(miss))
        self.cuts = d // self.bits
        centred = sample - self.mean
        self.turns, self.medians = [], []
        for i in range(-(-wanted // self.cuts)):
            self.turns.append(learn_rotation(centred, seed + i))
            self.medians.append(np.median(centred @ self.turns[-1], axis=0) if centre else np.zeros(d))
        self.tables = min(wanted, self.cuts * len(self.turns))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Substring of every table, one row per vector."""
        places = 1 << np.arange(self.bits, dtype=np.int64)
        out = []
        for turn, median in zip(self.turns, self.medians, strict=True):
            bits = (vectors - self.mean) @ turn >= median
            for c in range(self.cuts):
                out.append(bits[:, c * self.bits : (c + 1) * self.bits] @ places)
        return np.stack(out[: self.tables], axis=1)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, raws, sizes = [], [], []
        for v in batch.column("embedding").to_pylist():
            x = np.array(v, np.float64) if v and None not in v else np.zeros(1)
            if not np.isfinite(x).all() or not x.any():
                prints.append(None), raws.append(None), sizes.append(None)
                continue
            x = x + 0.0  # no negative zero
            prints.append(xxhash.xxh128_digest(x.tobytes()))
            raws.append(x.tobytes())
            sizes.append(len(x))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(prints, pa.binary()), pa.array(raws, pa.binary()), pa.array(sizes, pa.int32())],
            ["vec_id", "vec_print", "raw", "size"],
        )


def _units(column: pa.Array) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _index_rows(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = index.keys(_units(batch.column("raw")))
            flat = pa.array(keys.ravel().astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("rep", "copies", "raw")] + [lists], ["rep", "copies", "raw", "keys"]
            )

    return run


def _linked(cosine: float):
    """For each bucket, or pair of blocks of a crowded one: per vector the number of links and an edge to its component."""

    def answer(rows: pa.Table) -> pa.RecordBatch | None:
        reps, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        units = _units(rows.column("raw").combine_chunks())
        keys = rows.column("keys").combine_chunks()
        keys = keys.flatten().to_numpy().reshape(len(reps), -1)
        side, block = rows.column("side").to_numpy(), int(rows.column("across")[0].as_py())
        at = int(rows.column("at")[0].as_py())
        n = len(reps)
        links = np.zeros((n, n), bool)
        step = max(1, (1 << 22) // max(1, n * 8))
        for start in range(0, n, step):
            part = slice(start, start + step)
            like = units[part] @ units.T >= cosine
            if block:  # two blocks: only pairs across
                like &= side[part, None] != side[None, :]
            for t in range(at):  # met in an earlier table
                like &= keys[part, t, None] != keys[None, :, t]
            links[part] = like
        np.fill_diagonal(links, False)
        links |= links.T
        counts = links @ copies
        some = counts > 0
        if not some.any():
            return None
        label = smallest_reachable(links, reps)
        return pa.RecordBatch.from_arrays(
            [pa.array(reps[some]), pa.array(label[some]), pa.array(counts[some].astype(np.int64))], ["a", "b", "links"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            groups = batch.column("group").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(groups)) + 1), batch.num_rows]
            for x, y in zip(edges, edges[1:], strict=False):
                if x == y:
                    continue
                if held and groups[x] != key:
                    if sum(b.num_rows for b in held) > 1 and (out := answer(pa.Table.from_batches(held))) is not None:
                        yield out
                    held.clear()
                key = groups[x]
                held.append(batch.slice(x, y - x))
        if sum(b.num_rows for b in held) > 1 and (out := answer(pa.Table.from_batches(held))) is not None:
            yield out

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links and component_id of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    read = stored(
        vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
            _read, "vec_id long, vec_print binary, raw binary, size int"
        ),
        "vector-read",
    )
    usable = F.col("size").isNotNull() & F.col("vec_id").isNotNull()
    sizes = read.filter(usable).groupBy("size").count().filter("count > 1").orderBy("size").collect()
    found = [_of_length(spark, read.filter(usable & (F.col("size") == r["size"])), cosine, sample) for r in sizes]
    if not found:
        return read.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    named = functools.reduce(DataFrame.unionByName, found)
    joined = read.join(named, (F.col("vec_print") == F.col("_print")) & usable, "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )


def _of_length(spark: SparkSession, read: DataFrame, cosine: float, sample: int) -> DataFrame:
    """(_print, component_id, n_links) of the distinct vectors of one length, at least two rows of them."""
    classes = stored(
        read.groupBy("vec_print").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("raw").alias("raw")
        ),
        "vector-classes",
    )
    n = classes.count()
    drawn = classes.orderBy(F.xxhash64("vec_print"), "vec_print").limit(sample).select("raw").toArrow()
    index = Index(_units(drawn.column("raw").combine_chunks()), n, cosine)
    # Classes that share an id are told apart by their print in the links, and share a component by their id.
    coded = classes.select(F.xxhash64("vec_print").alias("rep"), "copies", "raw").mapInArrow(
        _index_rows(index), "rep long, copies long, raw binary, keys array<int>"
    )
    coded = stored(coded, "vector-codes")
    rows = coded.select("rep", "copies", "raw", "keys", F.posexplode("keys").alias("at", "_key")).withColumn(
        "_bucket", F.xxhash64("at", "_key")
    )
    places = coded.select(F.posexplode("keys").alias("at", "_key")).select(F.xxhash64("at", "_key").alias("_b"))
    sizes = places.groupBy("_b").agg(F.count("*").alias("_n"))
    crowded = stored(
        sizes.filter(F.col("_n") > BLOCK).withColumn("_blocks", F.ceil(F.col("_n") / BLOCK).cast("int")), "vector-crowded"
    )
    dealt = rows.join(crowded, F.col("_bucket") == F.col("_b"), "left").withColumns({
        "_blocks": F.coalesce("_blocks", F.lit(1)), "_own": F.pmod(F.xxhash64("rep"), F.coalesce("_blocks", F.lit(1))).cast("int")
    })
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    paired = dealt.select("rep", "copies", "raw", "keys", "at", "_bucket", "_own", other).select(
        "rep", "copies", "raw", "keys", "at", F.col("_own").alias("side"),
        (F.col("_own") != F.col("_other")).cast("int").alias("across"),
        F.xxhash64("_bucket", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("group"),
    )
    sorted_rows = paired.repartition(shuffle_tasks(spark), "group").sortWithinPartitions("group")
    found = stored(sorted_rows.mapInArrow(_linked(cosine), "a long, b long, links long"), "vector-links")
    names = classes.select(F.xxhash64("vec_print").alias("_name"), "vec_print", "rep", "copies")
    comps = stored(components(found.select("a", "b")), "vector-components")
    # A component is named by its smallest vec_id.
    grouped = names.join(comps, F.col("_name") == F.col("node"), "left").withColumn(
        "_component", F.coalesce("component", "_name")
    )
    grouped = stored(grouped, "vector-grouped")
    least = stored(
        grouped.groupBy(F.col("_component").alias("_c")).agg(F.min("rep").alias("component_id")), "vector-least"
    )
    counted = found.groupBy(F.col("a").alias("_a")).agg(F.sum("links").alias("_links"))
    return stored(
        grouped.join(least, F.col("_component") == F.col("_c"))
        .join(counted, F.col("_name") == F.col("_a"), "left")
        .select(
            F.col("vec_print").alias("_print"), "component_id",
            (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "vector-named",
    )


def op8_itq_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_vectors(table(spark, sf_dir, "embeddings"))
    return out.withColumn("kept", same(F.col("vec_id"), F.col("component_id")))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), good AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
  ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1),
counted AS (SELECT a, count(*) AS n FROM link GROUP BY 1)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v JOIN least l ON v.vec_id = l.a LEFT JOIN counted c ON v.vec_id = c.a
"""
