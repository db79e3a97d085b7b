"""Bringing loosely shaped input to known columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sarraf.functions.text import clean_name, is_junk_name


def clean_columns(df: DataFrame, *extra: Column) -> DataFrame:
    """Every column under its cleaned name, then ``extra`` columns as they are.

    Names that collide after cleaning are an error.
    """
    names = [clean_name(c) for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column names collide after cleaning: {repeated}")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)], *extra)


def drop_junk_columns(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in df.columns if not is_junk_name(c)])


def harmonise(df: DataFrame, synonyms: Mapping[str, str], required: Mapping[str, str]) -> DataFrame:
    """Rename synonyms to their target; the first source column of a target wins.

    Unknown columns pass through, technical ones (leading ``_``) are dropped, and
    ``required`` columns (name to type) that are missing come in as NULL.
    """
    chosen: dict[str, str] = {}
    for source in df.columns:
        if source.startswith("_"):
            continue
        cleaned = clean_name(source)
        chosen.setdefault(synonyms.get(cleaned, cleaned), source)
    columns = [F.col(f"`{source}`").alias(target) for target, source in chosen.items()]
    columns += [F.lit(None).cast(t).alias(c) for c, t in required.items() if c not in chosen]
    return df.select(columns)


def pick(df: DataFrame, name: str, kind: str = "string", default=None) -> Column:
    """Column ``name`` as ``kind``, or the default if the input lacks it.

    Text is cast tolerantly: a value that does not parse becomes NULL.
    """
    if name in df.columns:
        c = F.col(name)
        return c.cast("string") if kind == "string" else c.try_cast(kind)
    return F.lit(default).cast(kind)


def pick_first(df: DataFrame, *names: str) -> Column:
    """First of ``names`` that the input has, as text; NULL if it has none."""
    for name in names:
        if name in df.columns:
            return F.col(name).cast("string")
    return F.lit(None).cast("string")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns.

    Frames are united in pairs, pairs in pairs and so on: a chain of n unions
    would have Spark analyse a growing plan n times.
    """
    left = list(frames)
    while len(left) > 1:
        paired = [a.unionByName(b) for a, b in zip(left[::2], left[1::2])]
        left = paired + left[len(paired) * 2:]
    return left[0]
