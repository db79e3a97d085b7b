"""Quality rules: text statistics, and line frequency across the documents of a host.

Lines are normalised (ASCII lower case, numbers that stand alone among words as
0, white space as one space) and hashed.  A line that more than ``line_limit`` texts
of a host hold, and more than ``line_percent`` percent of them or more than
``line_ceiling`` texts, is a template line and is removed; a document that loses over ``depleted_percent`` percent of its words to that is rejected.  The
host of a document is its ``source``.  Texts that are equal count once: copies
are no sign of a template, and finding them is the work of other operators.

Counts cover all documents.  They are summed in the map tasks first, so a line,
host or text with a third of all rows costs no task more than others.

Nulls: a null text has no words and fails the base rules; a null source is a
host of its own.  Empty lines are never template lines.  Repeated rows are judged alike.
Empty tables give empty results; other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from sarraf.llm.common import frugal, same, stored, table

MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30
LINE_LIMIT = 20
LINE_PERCENT = 5
#: Texts of a host that make a line a template line however large the host is.
LINE_CEILING = 1000
DEPLETED_PERCENT = 70

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = re.compile(r"[#*$%&|<>]+")


def normalised(line: bytes) -> bytes:
    """ASCII lower case, one space between words; numbers among other words count as one number."""
    words = line.lower().split()
    numbers = [w.isdigit() for w in words]
    if any(numbers) and not all(numbers):
        words = [b"0" if number else w for w, number in zip(words, numbers, strict=True)]
    return b" ".join(words)


def line_hash(line: bytes) -> int:
    """64-bit hash of a normalised line, signed."""
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words (a power of 2) which the text holds twice or more."""
    if len(words) <= width:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    step, kinds = 1, len(numbers)
    while step < width:  # numbers of windows of twice the width, from pairs of numbers
        pairs = ids[:-step] * kinds + ids[step:]
        found, ids = np.unique(pairs, return_inverse=True)
        kinds, step = len(found), step * 2
        if kinds == len(ids):
            return 0
    twice = np.bincount(ids)[ids] > 1
    starts = np.flatnonzero(twice)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """The values of ``STATS`` for a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    letters = sum(len(w.decode("utf-8", "surrogatepass")) for w in words) if len(raw) != len(text) else sum(map(len, words))
    symbols = sum(map(len, _SYMBOLS.findall(text)))
    lines = [line for line in raw.split(b"\n") if line.split()]
    return len(words), letters, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _analyse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats, hashes, sizes = [], [], []
        for text in (t.as_py() for t in batch.column("text")):
            stats.append(text_stats(text))
            own = [normalised(x) for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]
            own = [x for x in own if x]
            hashes.append([line_hash(x) for x in own])
            sizes.append([x.count(b" ") + 1 for x in own])
        columns = {c: batch.column(c) for c in ("doc_id", "source", "_text")}
        columns |= {c: pa.array([s[i] for s in stats], pa.int64()) for i, c in enumerate(STATS)}
        columns |= {"_lines": pa.array(hashes, pa.list_(pa.int64())), "_sizes": pa.array(sizes, pa.list_(pa.int64()))}
        yield pa.RecordBatch.from_pydict(columns)


def assess(
    docs: DataFrame, line_limit: int = LINE_LIMIT, line_percent: int = LINE_PERCENT,
    depleted_percent: int = DEPLETED_PERCENT, line_ceiling: int = LINE_CEILING,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): statistics, words lost to template lines and the verdict.

    ``removed_lines`` holds the hashes of its template lines.
    """
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("_text"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    parsed = rows.mapInArrow(
        frugal(_analyse),
        f"doc_id {kind}, source string, _text long, {', '.join(f'{c} long' for c in STATS)}, "
        "_lines array<long>, _sizes array<long>",
    )
    # Row numbers are fixed by writing them.
    parsed = stored(parsed.withColumn("_row", F.monotonically_increasing_id()), "quality-parsed")
    texts = stored(
        parsed.groupBy("source", "_text").agg(F.first("_lines").alias("_lines")).drop("_text"), "quality-texts"
    )
    hosts = stored(
        texts.groupBy(F.col("source").alias("_host")).agg(F.count("*").alias("_texts")), "quality-hosts"
    )
    held = texts.select("source", F.explode(F.array_distinct("_lines")).alias("_line"))
    counts = held.groupBy("source", "_line").agg(F.count("*").alias("_n")).filter(F.col("_n") > line_limit)
    template = stored(
        counts.join(hosts, same(F.col("source"), F.col("_host")))
        .filter((F.col("_n") * 100 > line_percent * F.col("_texts")) | (F.col("_n") > line_ceiling))
        .select("_host", F.col("_line").alias("_template")),
        "quality-template",
    )
    lines = parsed.select("_row", "source", F.explode(F.arrays_zip("_lines", "_sizes")).alias("_l"))
    lost = (
        lines.join(template, same(F.col("source"), F.col("_host")) & (F.col("_l._lines") == F.col("_template")))
        .groupBy(F.col("_row").alias("_lost_row"))
        .agg(F.sum("_l._sizes").alias("lost_words"), F.collect_set("_template").alias("removed_lines"))
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    depleted = F.col("lost_words") * 100 > depleted_percent * F.col("n_words")
    judged = parsed.join(lost, F.col("_row") == F.col("_lost_row"), "left").withColumns(
        {"lost_words": F.coalesce("lost_words", F.lit(0)), "base_failed": base_failed}
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted).select(
        "doc_id", "source", F.col("_text").alias("text_hash"), *STATS, "lost_words", "removed_lines", "base_failed", "kept"
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = batch.column("text").to_pylist(), batch.column("_gone").to_pylist()
        for i, lines in enumerate(gone):
            if lines:
                lines = set(lines)
                raw = texts[i].encode("utf-8", "surrogatepass").split(b"\n")
                kept = [x for x in raw if not x.split() or line_hash(normalised(x)) not in lines]
                texts[i] = b"\n".join(kept).decode("utf-8", "surrogatepass")
        names = batch.schema.names
        columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names if c != "_gone"]
        yield pa.RecordBatch.from_arrays(columns, [c for c in names if c != "_gone"])


def clean(docs: DataFrame, **limits: int) -> DataFrame:
    """The kept rows of ``docs`` without their template lines; all columns stay, ``n_chars`` follows the text."""
    verdicts = assess(docs, **limits)
    per_text = stored(
        verdicts.filter("kept")
        .groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("text_hash").alias("_hash"))
        .agg(F.first("removed_lines").alias("_gone")),
        "quality-kept",
    )
    key = same(F.col("doc_id"), F.col("_id")) & same(F.col("source"), F.col("_src")) & (F.xxhash64("text") == F.col("_hash"))
    kept = docs.join(per_text, key).select(*docs.columns, "_gone")
    out = kept.mapInArrow(frugal(_without), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = assess(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *STATS, "base_failed", "kept", "lost_words")


OP1_SQL = r"""
WITH line AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS raw FROM documents WHERE text IS NOT NULL
), norm AS (
  SELECT doc_id, source, text, raw, array_to_string(
    CASE WHEN len(list_filter(ws, lambda w: NOT regexp_full_match(w, '[0-9]+'))) > 0
      THEN list_transform(ws, lambda w: CASE WHEN regexp_full_match(w, '[0-9]+') THEN '0' ELSE w END) ELSE ws END, ' ') AS l
  FROM (SELECT *, regexp_extract_all(
          translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM line)
), held AS (SELECT * FROM norm WHERE l <> ''),
counts AS (SELECT source, l, count(DISTINCT text) AS n FROM held GROUP BY 1, 2),
hosts AS (SELECT source, count(DISTINCT coalesce('=' || text, '')) AS texts FROM documents GROUP BY 1),
template AS (
  SELECT c.source, c.l FROM counts c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE n > 20 AND (n * 100 > 5 * texts OR n > 1000)
),
lost AS (
  SELECT doc_id, sum(len(string_split(h.l, ' '))) AS lost_words
  FROM held h JOIN template t ON h.source IS NOT DISTINCT FROM t.source AND h.l = t.l GROUP BY 1
),
dup AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n_dup_lines FROM held GROUP BY 1),
word AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         len(array_to_string(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]+'), '')) AS n_symbols
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM word WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice CROSS JOIN (SELECT unnest(generate_series(0, 7)) AS k) GROUP BY 1
), stats AS (
  SELECT w.doc_id, len(w.w) AS n_words, len(array_to_string(w.w, '')) AS word_chars, w.n_symbols,
         coalesce(d.n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         coalesce(l.lost_words, 0) AS lost_words
  FROM word w LEFT JOIN dup d USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN lost l USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (lost_words * 100 > 70 * n_words) AS kept,
       lost_words::BIGINT AS lost_words
FROM stats
"""
