"""Text-cleaning steps as Spark Column expressions.

Every step is ``Column -> Column`` built from native string functions, so the
whole chain stays inside whole-stage codegen. ``clean_text(col, config)``
composes the enabled steps in the fixed order of the reference pipeline:

    html -> whitespace -> encoding -> currency -> units
    -> (dashes -> quotes -> non-printable) -> repeated punctuation
    -> space after punctuation -> [typos, a relational step] -> whitespace

Disabled steps add no expression. Typo correction needs a dictionary join and
is applied by ``textforge.operators.typo``; the chain here is split around it
(``clean_text_before_typos`` / ``clean_text_after_typos``).
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textforge.config import CleaningConfig
from textforge.functions.patterns import ASCII_WS, DIGIT, WS, WS_RUN

ColFn = Callable[[Column], Column]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def where_any(col: Column, parts, fn: ColFn, beyond_ascii: bool = False) -> Column:
    """``fn`` only for texts with any of ``parts`` (or with a character beyond ASCII): looking for bytes costs far less than a search."""
    def each(x: Column) -> Column:
        tests = ([F.octet_length(x) > F.length(x)] if beyond_ascii else []) + [x.contains(p) for p in parts]
        return F.when(reduce(or_, tests), fn(x)).otherwise(x)

    return bound(col, each)


# C1 ------------------------------------------------------------------------
def remove_html_tags(col: Column | str) -> Column:
    """Naive tag removal: every ``<...>`` (shortest, across lines) -> one space."""
    return where_any(_c(col), ("<",), lambda x: F.regexp_replace(x, r"(?s)<.*?>", " "))


# C2 ------------------------------------------------------------------------
def normalize_whitespace(col: Column | str) -> Column:
    """Collapse whitespace runs (Python's Unicode set) to one space and strip."""
    # After the collapse only U+0020 can sit at either end, so trim() suffices.
    return F.trim(where_any(_c(col), ("  ", *ASCII_WS), lambda x: F.regexp_replace(x, WS_RUN, " "), beyond_ascii=True))


# C4 / C5 -------------------------------------------------------------------
# The Unicode dashes mapped to '-' (U+2010..U+2015, U+2212).
UNICODE_DASHES = "‐‑‒–—―−"
# Curly double quotes -> '"', curly single quotes -> "'".
SMART_DOUBLE = "“”"
SMART_SINGLE = "‘’"


def normalize_unicode_dashes(col: Column | str) -> Column:
    return F.translate(_c(col), UNICODE_DASHES, "-" * len(UNICODE_DASHES))


def normalize_smart_quotes(col: Column | str) -> Column:
    return F.translate(_c(col), SMART_DOUBLE + SMART_SINGLE, '""' + "''")


def _dashes_and_quotes(col: Column, dashes: bool, quotes: bool) -> Column:
    # One translate pass for both (they touch disjoint characters).
    src, dst = "", ""
    if dashes:
        src += UNICODE_DASHES
        dst += "-" * len(UNICODE_DASHES)
    if quotes:
        src += SMART_DOUBLE + SMART_SINGLE
        dst += '""' + "''"
    # Texts of ASCII alone have none of them.
    return bound(col, lambda x: F.when(F.octet_length(x) > F.length(x), F.translate(x, src, dst)).otherwise(x)) if src else col


# C6 ------------------------------------------------------------------------
def remove_non_printable(col: Column | str) -> Column:
    """Keep only Python's ``string.printable``: ASCII 0x20-0x7E and \\t\\n\\x0b\\x0c\\r."""
    return F.regexp_replace(_c(col), r"[^\x20-\x7E\t\n\x0B\f\r]", "")


# C8 ------------------------------------------------------------------------
def remove_excessive_punctuation(col: Column | str) -> Column:
    """``..``->``.``, ``,,``->``,``, ``!!``->``!``, ``??``->``?``, ``--``->``-``.

    The reference applies five rules in turn; collapsing a run of one mark never
    creates a run of another, so one back-referencing pass is equivalent.
    """
    return where_any(_c(col), [2 * mark for mark in ".,!?-"], lambda x: F.regexp_replace(x, r"([.,!?\-])\1+", "$1"))


# C9 ------------------------------------------------------------------------
def add_space_after_punctuation(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), r"([.,?!])(?=[a-zA-Z0-9])", "$1 ")


# C10 -----------------------------------------------------------------------
# Currency rules, applied in this order.
#   $ N[.NN]          -> USD N[.NN]
#   N €               -> N EUR
#   £ N[.NN]          -> GBP N[.NN]
#   usd | us dollar(s)           -> USD   (any case, whole word)
#   eur | euro(s)                -> EUR   (any case, whole word)
#   gbp | pound(s)sterling       -> GBP   (any case, whole word)
CURRENCY_RULES: tuple[tuple[str, str], ...] = (
    (rf"\${WS}*({DIGIT}+(?:\.{DIGIT}{{1,2}})?)", "USD $1"),
    (rf"({DIGIT}+){WS}*€", "$1 EUR"),
    (rf"£{WS}*({DIGIT}+(?:\.{DIGIT}{{1,2}})?)", "GBP $1"),
    (r"(?iU)\b(?:usd|us dollars?)\b", "USD"),
    (r"(?iU)\b(?:eur|euros?)\b", "EUR"),
    (r"(?iU)\b(?:gbp|pounds?sterling)\b", "GBP"),
)


# The rules joined, as their matches never overlap and none makes a match of another but of the same outcome: one search marks
# all matches, and the marks become words by byte searches. Texts that hold MARK themselves are left to the rules one by one.
# A run of digits is tried once, from its start: what follows it is the same from wherever in the run a match begins. Letters are
# looked for as they are (of those below, only s has another character that folds to it) before case and word boundaries are
# compared by Unicode's rules.
MARK = "\uE000"
CURRENCY_INITIALS = r"(?=[uU][sS\x{17F}]|[eE][uU]|[gG][bB]|[pP][oO])"
CURRENCY_JOINED = (
    (rf"([$£]){WS}*({DIGIT}+(?:\.{DIGIT}{{1,2}})?)", f"{MARK}$1 $2", {"$": "USD", "£": "GBP"}),
    (rf"(?<!{DIGIT})({DIGIT}++){WS}*+€", "$1 EUR", {}),
    (rf"{CURRENCY_INITIALS}(?iU:\b(?:([uU])(?:sd|s dollars?)|([eE])(?:ur|uros?)|([gG])bp|([pP])ounds?sterling)\b)", f"{MARK}$1$2$3$4",
     {"u": "USD", "U": "USD", "e": "EUR", "E": "EUR", "g": "GBP", "G": "GBP", "p": "GBP", "P": "GBP"}),
)


def by_rules(col: Column, rules) -> Column:
    for pat, rep in rules:
        col = F.regexp_replace(col, pat, rep)
    return col


def by_marks(col: Column, joined) -> Column:
    for pat, rep, words in joined:
        if pat.endswith("€"):
            col = bound(col, lambda x: F.when(x.contains("€"), F.regexp_replace(x, pat, rep)).otherwise(x))  # noqa: B023
        else:
            col = F.regexp_replace(col, pat, rep)
        if words:
            col = named(col, words)
    return col


def named(col: Column, words: dict[str, str]) -> Column:
    """Marks become words, in texts that have any."""
    def each(x: Column) -> Column:
        c = x
        for mark, word in words.items():
            c = F.replace(c, F.lit(MARK + mark), F.lit(word))
        return F.when(x.contains(MARK), c).otherwise(x)

    return bound(col, each)


def bound(col: Column, fn: ColFn) -> Column:
    """``fn`` of a column that is computed once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(col), fn), 0)


def marked(x: Column, rules, joined) -> Column:
    return F.when(x.contains(MARK), by_rules(x, rules)).otherwise(by_marks(x, joined))


def standardize_currency(col: Column | str) -> Column:
    return bound(_c(col), lambda x: marked(x, CURRENCY_RULES, CURRENCY_JOINED))


# C11 -----------------------------------------------------------------------
# Unit suffix -> word, applied in this order (case-sensitive,
# integers only; percent also takes decimals).
UNIT_WORDS: tuple[tuple[str, str], ...] = (
    ("m", "meters"),
    ("km", "kilometers"),
    ("kg", "kilograms"),
    ("cm", "centimeters"),
    ("ft", "feet"),
    ("lbs", "pounds"),
    ("mi", "miles"),
    ("g", "grams"),
)
PERCENT_RULE = (rf"({DIGIT}+(?:\.{DIGIT}+)?){WS}*%", "$1 percent")


def unit_rules() -> list[tuple[str, str]]:
    rules = [PERCENT_RULE]
    for suffix, word in UNIT_WORDS:
        rules.append((rf"(?U)({DIGIT}+){WS}*{suffix}\b", f"$1 {word}"))
    return rules


# A number's digits before the point stay as they are, so the percent rule needs none of them.
UNITS_JOINED = ((
    rf"(?<!{DIGIT})({DIGIT}++){WS}*+((?U:%|(?:{'|'.join(suffix for suffix, _ in UNIT_WORDS)})\b))", f"$1 {MARK}$2{MARK}",
    {"%" + MARK: "percent"} | {suffix + MARK: word for suffix, word in UNIT_WORDS},
),)


def standardize_units(col: Column | str) -> Column:
    return bound(_c(col), lambda x: marked(x, unit_rules(), UNITS_JOINED))


# Texts without any of these have nothing for the currency and unit rules.
AMOUNT_GATE = rf"{DIGIT}|[$€£%]|{CURRENCY_INITIALS}(?iU:\b(?:usd|us dollar|eur|gbp|pounds?sterling))"


def where_needed(col: Column, pattern: str, fn: ColFn) -> Column:
    """``fn`` only for texts that match ``pattern``; the text is bound once, so it is computed once."""
    return bound(col, lambda x: F.when(x.rlike(pattern), fn(x)).otherwise(x))


# User-registered steps ------------------------------------------------
_STEP_REGISTRY: dict[str, ColFn] = {}


def register_step(name: str, fn: ColFn) -> None:
    """Register a ``Column -> Column`` cleaning step usable via ``extra_steps``."""
    _STEP_REGISTRY[name] = fn


def get_step(name: str) -> ColFn:
    return _STEP_REGISTRY[name]


# Example extension: emoji removal.
EMOJI_PATTERN = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
)


def remove_emoji(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), EMOJI_PATTERN, "")


register_step("remove_emoji", remove_emoji)


# Composition -------------------------------------------------------
def clean_text_before_typos(col: Column | str, cfg: CleaningConfig, python_ok: bool = True) -> Column:
    """Steps 1-8 of the chain (everything that precedes typo correction).

    ``python_ok=False`` (inside higher-order-function lambdas, where Python
    UDFs are not allowed) keeps only the native part of encoding repair.
    """
    c = _c(col)
    if cfg.remove_html_tags:
        c = remove_html_tags(c)
    if cfg.normalize_whitespace:
        c = normalize_whitespace(c)
    if cfg.fix_encoding:
        from textforge.functions.encoding import fix_encoding, fix_encoding_native

        c = fix_encoding(c) if python_ok else fix_encoding_native(c)
    steps = [s for on, *s in ((cfg.standardize_currency, CURRENCY_RULES, CURRENCY_JOINED), (cfg.standardize_units, unit_rules(), UNITS_JOINED)) if on]
    if steps:
        rules, joined = ([x for s in steps for x in s[i]] for i in (0, 1))
        c = where_needed(c, AMOUNT_GATE, lambda x: marked(x, rules, joined))
    if cfg.normalize_punctuation:
        c = _dashes_and_quotes(c, cfg.normalize_unicode_dashes, cfg.normalize_smart_quotes)
        c = remove_non_printable(c)
    if cfg.remove_excessive_punctuation:
        c = remove_excessive_punctuation(c)
    if cfg.add_space_after_punctuation:
        c = add_space_after_punctuation(c)
    for name in cfg.extra_steps:
        c = get_step(name)(c)
    return c


def clean_text_after_typos(col: Column | str, cfg: CleaningConfig) -> Column:
    c = _c(col)
    if cfg.normalize_whitespace:
        c = normalize_whitespace(c)
    return c


def clean_text(col: Column | str, cfg: CleaningConfig | None = None, python_ok: bool = True) -> Column:
    """The chain without the relational typo step (typos: ``operators.typo``)."""
    cfg = cfg or CleaningConfig()
    return clean_text_after_typos(clean_text_before_typos(col, cfg, python_ok), cfg)
