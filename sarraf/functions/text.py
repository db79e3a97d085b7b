"""Cleaning of names, money text, codes and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sarraf.functions import fixed_values as fv


def clean_name(name: str) -> str:
    """Column name with separators turned into ``_``, lower case, no outer ``_``."""
    return "".join("_" if letter in fv.NAME_SEPARATORS else letter for letter in name).lower().strip("_")


def is_junk_name(name: str) -> bool:
    """Unnamed index columns, ``.`` columns and blank headers carry no data."""
    return name.startswith("Unnamed") or name.strip() in ("", ".")


def tidy(c: Column) -> Column:
    return F.trim(c.cast("string"))


def tidy_upper(c: Column) -> Column:
    return F.upper(tidy(c))


def clean_money(c: Column) -> Column:
    """Amount in a text such as ``$1,234.50`` or ``77 MAD``; NULL if there is none."""
    return F.regexp_replace(c.cast("string"), r"[^0-9.\-]", "").try_cast("double")


def is_yes(c: Column) -> Column:
    return tidy_upper(c).isin(fv.YES_LABELS)


def contains_any(c: Column, *words: str) -> Column:
    hit = c.contains(words[0])
    for word in words[1:]:
        hit = hit | c.contains(word)
    return hit


def text_date(c: Column) -> Column:
    return c.cast("string").try_cast("date")


def text_timestamp(c: Column) -> Column:
    return c.cast("string").try_cast("timestamp")


def month_year_date(c: Column) -> Column:
    """First day of an ``MM/yyyy`` month; NULL for anything else."""
    return F.try_to_date(c.cast("string"), "MM/yyyy")


def clock_hour(c: Column) -> Column:
    """Hour in the first two characters of a clock text."""
    return F.substring(c.cast("string"), 1, 2).try_cast("int")


def digits(c: Column) -> Column:
    """First run of digits as a number; NULL if there is none."""
    return F.regexp_extract(c.cast("string"), r"(\d+)", 1).try_cast("bigint")


def error_code(c: Column) -> Column:
    """Numeric error code; ``NaN`` and free text become NULL."""
    return F.nullif(F.trim(c.cast("string")), F.lit("NaN")).try_cast("int")


def mask_number(c: Column) -> Column:
    """All but the last four characters hidden."""
    text = F.trim(c.cast("string"))
    return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(text) - 4, F.lit(0))), F.right(text, F.lit(4)))


def json_safe(c: Column) -> Column:
    """NaN and infinities have no JSON form; they become NULL."""
    inf = float("inf")
    return F.when(~(F.isnan(c) | (c == inf) | (c == -inf)), c)
