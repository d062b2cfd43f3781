"""Derived document metrics (E9-E11) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textforge.functions.patterns import WS


def word_count(cleaned: Column, whitespace_normalized: bool = True) -> Column:
    """Whitespace tokens of the cleaned text; null for empty/null text.

    After normalize_whitespace the text has single inner spaces and no edges,
    so a plain split on ' ' is exact and cheaper than a regex split.
    """
    if whitespace_normalized:
        n = F.size(F.split(cleaned, " "))
    else:
        n = F.size(F.filter(F.split(cleaned, f"{WS}+"), lambda w: w != ""))
    return F.when(cleaned.isNotNull() & (cleaned != ""), n.cast("int"))


def reading_time(words: Column, words_per_minute: int = 200) -> Column:
    """``max(1, round(words / wpm))`` with Python's half-even round; null if 0/null."""
    rt = F.greatest(F.lit(1), F.bround(words / F.lit(float(words_per_minute)), 0).cast("int"))
    return F.when(words.isNotNull() & (words != 0), rt)


def supplied_or(supplied: Column, computed: Column) -> Column:
    """A supplied value beats the computed one."""
    return F.when(supplied.isNotNull(), supplied).otherwise(computed)
