"""Mix sources to target weights with Sainte-Laguë apportionment of equal-token blocks.

Weights are turned into token targets (a source is repeated ``MAX_PASSES``
times at most, what it cannot supply goes to the others), targets into integer
block quotas by highest quotients ``target / (2 k + 1)``, and quotas into
blocks: the words of a source, its documents in seeded order, are cut into
blocks of equal size.  Sources too small for ``BLOCKS_AT_LEAST`` blocks of
``BLOCK_WORDS`` words have blocks of half, a quarter, ... of that; sources with
blocks of one size are apportioned together, so a small source changes nothing
for the others.

The apportionment is house monotone, so the quota of shard ``j`` is what the
first ``j + 1`` shards get less what the first ``j`` get.  The shards draw their
blocks one after the other from a seeded start, beginning anew after the last
block of the source: no block is taken once more before all others were.  As
documents stand in seeded order, a run of blocks is a random sample of them, and
only the documents at its ends are cut.

Only sums per source meet in one task.  The place of a document among the
words of its source comes from two levels of running sums, so a source with a
third of all rows is spread over as many tasks as any other.

Nulls: a null text has size 0, a null source is a source of its own and comes
last, a null doc_id is an id like others.  Repeated rows count as often as they
occur.  Empty tables give empty results.  Other columns are left alone, also
those called ``size``, ``target`` or ``taken``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sarraf.llm.common import n_words, same, stored, table

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
SHARDS = 8
#: Most words of a block; small sources have smaller ones, so that they have ``BLOCKS_AT_LEAST`` of them.
BLOCK_WORDS = 2048
BLOCKS_AT_LEAST = 128


def targets(sizes: Sequence[int], weights: Sequence[float], passes: int = MAX_PASSES) -> list[float]:
    """Words each source should give: shares of the total by weight, none above ``passes`` times its size."""
    goal = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = float(sum(sizes))
    while open_:
        whole = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] > passes * sizes[i] * whole]
        if not full:
            for i in open_:
                goal[i] = left * weights[i] / whole
            break
        for i in full:
            goal[i] = float(passes * sizes[i])
        left -= sum(goal[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return goal


def apportion(votes: Sequence[float], house: int, caps: Sequence[int]) -> list[int]:
    """Seats by Sainte-Laguë: each goes to the highest ``votes / (2 seats + 1)``; no party gets more than its cap.

    All seats whose quotient is above a bound are given at once; the few at the
    bound go one by one.  Ties go to the earlier party.
    """
    house = min(house, sum(caps))

    def at(scale: float) -> list[int]:
        return [min(c, math.floor(scale * v + 0.5)) for v, c in zip(votes, caps, strict=True)]

    low, high = 0.0, 1.0
    if not any(v > 0 and c > 0 for v, c in zip(votes, caps, strict=True)):
        return [0] * len(votes)
    while sum(at(high)) < house and high < 1e300:
        low, high = high, high * 2
    for _ in range(200):
        middle = (low + high) / 2
        if sum(at(middle)) <= house:
            low = middle
        else:
            high = middle
    seats = at(low)
    queue = [(-v / (2 * s + 1), i) for i, (v, s, c) in enumerate(zip(votes, seats, caps, strict=True)) if s < c and v > 0]
    heapq.heapify(queue)
    for _ in range(house - sum(seats)):
        if not queue:
            break
        _, i = heapq.heappop(queue)
        seats[i] += 1
        if seats[i] < caps[i]:
            heapq.heappush(queue, (-votes[i] / (2 * seats[i] + 1), i))
    return seats


def block_size(size: int, block_words: int = BLOCK_WORDS) -> int:
    """``block_words``, halved until a source of ``size`` words has enough blocks."""
    while block_words > 1 and size < BLOCKS_AT_LEAST * block_words:
        block_words //= 2
    return block_words


def shard_quotas(
    goal: Sequence[float], sizes: Sequence[int], shards: int, passes: int = MAX_PASSES, block_words: int = BLOCK_WORDS
) -> list[list[int]]:
    """Blocks of each source that each shard takes."""
    of_size = [block_size(s, block_words) for s in sizes]
    quotas = [[0] * shards for _ in sizes]
    for block in set(of_size):
        group = [i for i, b in enumerate(of_size) if b == block]
        caps = [passes * -(-sizes[i] // block) for i in group]
        votes = [goal[i] for i in group]
        house = round(sum(votes) / block)
        before = [0] * len(group)
        for j in range(shards):
            seats = apportion(votes, house * (j + 1) // shards, caps)
            for i, a, b in zip(group, before, seats, strict=True):
                quotas[i][j] = b - a
            before = seats
    return quotas


def _plan(weights: Sequence[float], passes: int, shards: int, block_words: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([*batches, pd.DataFrame({"source": [], "source_size": []})], ignore_index=True)
        rows = sorted(
            zip(pdf["source"], pdf["source_size"], strict=True),
            key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")),
        )
        if not rows:
            return
        names, sizes = [r[0] for r in rows], [int(r[1]) for r in rows]
        goal = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], passes)
        of_size = [block_size(s, block_words) for s in sizes]
        blocks = [-(-s // b) for s, b in zip(sizes, of_size, strict=True)]
        quotas = shard_quotas(goal, sizes, shards, passes, block_words)
        draw = np.random.default_rng(seed)
        yield pd.DataFrame(
            {
                "source": pd.Series(names, dtype=object),
                "source_size": sizes,
                "target": goal,
                "block_words": of_size,
                "n_blocks": blocks,
                "quota": [sum(q) for q in quotas],
                "start_block": [int(draw.integers(b)) if b else 0 for b in blocks],
                "shard_quotas": quotas,
            }
        )

    return run


def source_plan(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, passes: int = MAX_PASSES, shards: int = SHARDS,
    block_words: int = BLOCK_WORDS, seed: int = 17,
) -> DataFrame:
    """One row per source of ``sizes`` (source, size): target, block quota, quota of each shard, start of the last pass."""
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    return sums.coalesce(1).mapInPandas(
        _plan(tuple(weights), passes, shards, block_words, seed),
        "source string, source_size long, target double, block_words long, n_blocks long, quota long, "
        "start_block long, shard_quotas array<long>",
    )


def _overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.greatest(F.least(b, d) - F.greatest(a, c), F.lit(0))


def document_quotas(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, passes: int = MAX_PASSES, shards: int = SHARDS,
    block_words: int = BLOCK_WORDS, seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): per row doc_id, source, text_hash, size, source_size, target, taken, shard_taken; per source its plan.

    ``shard_taken`` has the words that shards 0, 1, ... take of the row as fields shard_0, shard_1, ...; ``taken`` is their sum.

    ``docs`` needs doc_id, text and source.
    """
    rows = stored(
        docs.select(
            "doc_id", "source", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("_h"),
        ),
        "mix-sizes",
    )
    plan = stored(source_plan(rows, weights, passes, shards, block_words, seed), "mix-plan")
    slices = max(1, math.isqrt(rows.count()))
    rows = rows.withColumn("_slice", F.pmod("_h", F.lit(slices)))
    by_slice = rows.groupBy("source", "_slice").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        by_slice.select(
            F.col("source").alias("_source"), F.col("_slice").alias("_at"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        ),
        "mix-offsets",
    )
    inside = (
        Window.partitionBy("source", "_slice").orderBy("_h", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.withColumn("_in", F.sum("size").over(inside)).join(
        offsets, same(F.col("source"), F.col("_source")) & (F.col("_slice") == F.col("_at"))
    )
    planned = placed.drop("_source").join(
        plan.withColumnRenamed("source", "_source"), same(F.col("source"), F.col("_source"))
    )
    end = F.col("_before") + F.col("_in")
    begin = end - F.col("size")
    block, n, start = F.col("block_words"), F.col("n_blocks"), F.col("start_block")

    def words_of_first(blocks: Column) -> Column:
        """Words of the row among so many blocks from the start."""
        whole = F.when(n > 0, F.floor(blocks / n)).otherwise(0)
        last = start + blocks - whole * n
        return (
            whole * F.col("size") + _overlap(begin, end, start * block, last * block)
            + _overlap(begin, end, F.lit(0), (last - n) * block)
        ).cast("long")

    up_to = [F.lit(0).cast("long")]
    for j in range(shards):
        up_to.append(up_to[-1] + F.element_at("shard_quotas", j + 1))
    cuts = enumerate(zip(up_to, up_to[1:], strict=False))
    per_shard = F.struct(*((words_of_first(b) - words_of_first(a)).alias(f"shard_{j}") for j, (a, b) in cuts))
    out = planned.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", words_of_first(F.col("quota")).alias("taken"),
        per_shard.alias("shard_taken"),
    )
    return out, plan


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it, whole.

    A row whose words are taken 1.6 times occurs twice: only the rows at the
    ends of a source's last pass are not taken a whole number of times.  Rows
    without words are not taken.
    """
    quotas, _ = document_quotas(docs, **options)
    per_text = stored(
        quotas.filter("taken > 0")
        .groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("text_hash").alias("_hash"))
        .agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias("_times")),
        "mix-times",
    )
    key = same(F.col("doc_id"), F.col("_id")) & same(F.col("source"), F.col("_src")) & (F.xxhash64("text") == F.col("_hash"))
    joined = docs.join(per_text, key)
    copies = joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times"))))
    return copies.select(*docs.columns)


def op10_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shard_taken``: the words that shards 0, 1, ... take, joined by commas."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    quotas = document_quotas(docs)[0]
    per_shard = F.concat_ws(",", *(F.col(f"shard_taken.shard_{j}").cast("string") for j in range(SHARDS)))
    return quotas.select("doc_id", "size", "source_size", "target", "taken", per_shard.alias("shard_taken"))
