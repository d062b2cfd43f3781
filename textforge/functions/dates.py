"""Normalise a date phrase to ``YYYY-MM-DD`` relative to a reference date.

Supported grammar (whole phrase, any case; anything else gives null):

* ``last <weekday>`` at the start (the rest of the phrase is ignored) ->
  most recent strictly earlier such weekday;
* ISO ``YYYY-MM-DD``; ``Month D, YYYY`` (also ``5th``, ``Jan.``, ``Sept``, no comma); ``D Month YYYY``
  (full or short month names); ``M/D/YYYY`` (month first);
* ``today``, ``yesterday``, ``tomorrow``;
* ``N day(s)|week(s)|month(s)|year(s) ago``; ``in N day(s)|week(s)``, any N whose date is a date;
* ``last|this|next week|month|year``.

Incomplete dates (``March 2024``) are null, as with strict parsing. A whole document is handed in for lack of a DATE
entity: texts whose first characters open no phrase are skipped by one anchored match.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textforge.functions.clean import bound
from textforge.functions.patterns import WS

# What a phrase can begin with.
OPENING = rf"(?i)^{WS}*(?:last|this|next|in|today|yesterday|tomorrow|[0-9]+|[a-z]{{3,9}}[.]?{WS}+[0-9]){WS}?"

# Weekday names, Monday first (Monday = 0).
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def last_weekday(ref: Column, weekday_index: Column) -> Column:
    """Most recent strictly-earlier date falling on ``weekday_index`` (Mon=0): one to seven days back."""
    return F.date_sub(ref, ((F.weekday(ref) - weekday_index + 6) % 7 + 1).cast("int"))


def _shifted(ref: Column, n: Column, unit: Column, sign: int) -> Column:
    """``ref`` moved by ``n`` units; null beyond the years 1 to 9999."""
    days = F.when(unit == "day", n).when(unit == "week", n * 7)
    months = F.when(unit == "month", n).when(unit == "year", n * 12)
    room = F.datediff(ref, F.lit("0001-01-01").cast("date")) if sign < 0 else F.datediff(F.lit("9999-12-31").cast("date"), ref)
    by_days = F.date_add(ref, (sign * F.when(days <= room, days)).cast("int"))
    by_months = F.add_months(ref, (sign * F.when(months * 28 <= room, months)).cast("int"))
    moved = F.coalesce(by_days, by_months)
    return F.when(F.year(moved).between(1, 9999), moved)


def _weekday_index(name: Column) -> Column:
    idx = None
    for i, w in enumerate(WEEKDAYS):
        idx = F.when(name == w, F.lit(i)) if idx is None else idx.when(name == w, F.lit(i))
    return idx


def normalize_date(text: Column, ref: Column) -> Column:
    """Date phrase -> 'YYYY-MM-DD' string or null (E5, E6). The text is computed and looked at once; only what opens a phrase goes on."""
    phrase = bound(text, lambda t: F.when(t.rlike(OPENING), t))
    return bound(phrase, lambda t: F.when(t.isNotNull(), bound(
        F.lower(F.regexp_replace(F.regexp_replace(t, f"^{WS}+|{WS}+$", ""), f"{WS}+", " ")),
        lambda s: bound(F.lower(F.regexp_extract(t, rf"(?i)^last{WS}+([a-zA-Z]+)", 1)), lambda day: _dated(s, _weekday_index(day), ref.cast("date"))))))


def _dated(s: Column, wd_idx: Column, ref: Column) -> Column:
    """Of a phrase in small letters, with single spaces."""
    # nine digits are more than any date is away, and fit an int times twelve in a long
    n = F.regexp_extract(s, r"^(?:in )?0*([0-9]{1,9}) ", 1).try_cast("bigint")
    ago = F.regexp_extract(s, r"^[0-9]+ (day|week|month|year)s? ago$", 1)
    ahead = F.regexp_extract(s, r"^in [0-9]+ (day|week)s?$", 1)
    near = F.regexp_extract(s, r"^(last|this|next) (?:week|month|year)$", 1)
    near_unit = F.regexp_extract(s, r"^(?:last|this|next) (week|month|year)$", 1)
    # one spelling for all month-first forms: no dot, no ordinal ending, no comma, Sep for Sept
    month_first = F.regexp_replace(F.when(s.rlike(r"^[a-z]+[.]? [0-9]{1,2}(?:st|nd|rd|th)?,? [0-9]{4}$"), s), r"[.,]|(?<=[0-9])(?:st|nd|rd|th)", "")
    day_first = F.regexp_replace(F.when(s.rlike(r"^[0-9]{1,2} [a-z]+[.]? [0-9]{4}$"), s), r"[.]", "")
    sept = lambda c: F.regexp_replace(c, r"\bsept\b", "sep")

    d = (
        F.when(ref.isNotNull() & wd_idx.isNotNull(), last_weekday(ref, wd_idx))
        .when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(s, "yyyy-MM-dd"))
        .when(month_first.isNotNull(), F.coalesce(F.try_to_date(sept(month_first), "MMMM d yyyy"), F.try_to_date(sept(month_first), "MMM d yyyy")))
        .when(day_first.isNotNull(), F.coalesce(F.try_to_date(sept(day_first), "d MMMM yyyy"), F.try_to_date(sept(day_first), "d MMM yyyy")))
        .when(s.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(s, "M/d/yyyy"))
        .when(s == "today", ref)
        .when(s == "yesterday", F.date_sub(ref, 1))
        .when(s == "tomorrow", F.date_add(ref, 1))
        .when(ago != "", _shifted(ref, n, ago, -1))
        .when(ahead != "", _shifted(ref, n, ahead, 1))
        .when(near == "last", _shifted(ref, F.lit(1), near_unit, -1))
        .when(near == "next", _shifted(ref, F.lit(1), near_unit, 1))
        .when(near == "this", ref)
    )
    return F.date_format(d, "yyyy-MM-dd")


def reference_date(publication_date: Column, run_date: str) -> Column:
    """Publication date, else the job's explicit run date."""
    return F.coalesce(publication_date.cast("date"), F.to_date(F.lit(run_date)))
