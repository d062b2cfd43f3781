"""DuckDB SQL text for the correctness oracle.

Builds the SQL twin of the Spark cleaning expressions. RE2 (DuckDB) has no
lookaround, no back-references and an ASCII ``\\b``; the rewrites used here:

* ``(?=X)`` lookahead      -> capture X and put it back (X is never re-scanned
  as a match start, which is safe for every rule below);
* ``(.)\\1+`` run collapse  -> one rule per punctuation mark, as the reference;
* Unicode ``\\b``           -> ``(^|[^\\p{L}\\p{N}_])`` ... ``([^\\p{L}\\p{N}_]|$)``
  captured and restored; word rules run twice so back-to-back hits that share
  one separator are all replaced.
"""

from __future__ import annotations

from textforge.config import CleaningConfig
from textforge.functions.clean import SMART_DOUBLE, SMART_SINGLE, UNICODE_DASHES, UNIT_WORDS
from textforge.functions.patterns import DIGIT, WORD_CHARS, WS

NW = f"[^{WORD_CHARS}]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(e: str, pat: str, rep: str) -> str:
    return f"regexp_replace({e}, {lit(pat)}, {lit(rep)}, 'g')"


def sql_html(e: str) -> str:
    return rr(e, r"(?s)<.*?>", " ")


def sql_ws(e: str) -> str:
    return f"trim({rr(e, WS + '+', ' ')})"


def sql_currency(e: str) -> str:
    e = rr(e, rf"\${WS}*({DIGIT}+(?:\.{DIGIT}{{1,2}})?)", r"USD \1")
    e = rr(e, rf"({DIGIT}+){WS}*€", r"\1 EUR")
    e = rr(e, rf"£{WS}*({DIGIT}+(?:\.{DIGIT}{{1,2}})?)", r"GBP \1")
    # A private-use sentinel stands in for the word so the second pass cannot
    # re-match a replacement; sentinels become the words at the end.
    rules = (("usd|us dollars?", "USD", "\ue000"), ("eur|euros?", "EUR", "\ue001"),
             ("gbp|pounds?sterling", "GBP", "\ue002"))
    for words, _rep, mark in rules:
        for _ in range(2):
            e = rr(e, rf"(^|{NW})(?i:{words})({NW}|$)", rf"\1{mark}\2")
    for _words, rep, mark in rules:
        e = f"replace({e}, {lit(mark)}, {lit(rep)})"
    return e


def sql_units(e: str) -> str:
    e = rr(e, rf"({DIGIT}+(?:\.{DIGIT}+)?){WS}*%", r"\1 percent")
    for suffix, word in UNIT_WORDS:
        e = rr(e, rf"({DIGIT}+){WS}*{suffix}({NW}|$)", rf"\1 {word}\2")
    return e


def sql_punct(e: str, dashes: bool = True, quotes: bool = True) -> str:
    src, dst = "", ""
    if dashes:
        src += UNICODE_DASHES
        dst += "-" * len(UNICODE_DASHES)
    if quotes:
        src += SMART_DOUBLE + SMART_SINGLE
        dst += '""' + "''"
    if src:
        e = f"translate({e}, {lit(src)}, {lit(dst)})"
    return rr(e, r"[^\x20-\x7E\t\n\x0B\f\r]", "")


def sql_excess(e: str) -> str:
    for ch, esc in ((".", r"\."), (",", ","), ("!", "!"), ("?", r"\?"), ("-", "-")):
        e = rr(e, esc + "{2,}", ch)
    return e


def sql_space_after(e: str) -> str:
    return rr(e, r"([.,?!])([a-zA-Z0-9])", r"\1 \2")


def sql_clean(e: str, cfg: CleaningConfig) -> str:
    """SQL twin of ``clean_text`` (fix_encoding and typos must be off)."""
    e = sql_clean_pre(e, cfg)
    if cfg.normalize_whitespace:
        e = sql_ws(e)
    return e


def sql_clean_pre(e: str, cfg: CleaningConfig) -> str:
    """Steps 1-8 (everything before typo correction)."""
    assert not cfg.fix_encoding, "fix_encoding has no SQL twin"
    if cfg.remove_html_tags:
        e = sql_html(e)
    if cfg.normalize_whitespace:
        e = sql_ws(e)
    if cfg.standardize_currency:
        e = sql_currency(e)
    if cfg.standardize_units:
        e = sql_units(e)
    if cfg.normalize_punctuation:
        e = sql_punct(e, cfg.normalize_unicode_dashes, cfg.normalize_smart_quotes)
    if cfg.remove_excessive_punctuation:
        e = sql_excess(e)
    if cfg.add_space_after_punctuation:
        e = sql_space_after(e)
    return e


def sql_word_count(e: str) -> str:
    return f"CASE WHEN {e} <> '' THEN CAST(len(string_split({e}, ' ')) AS INTEGER) END"


def sql_reading_time(wc: str, wpm: int = 200) -> str:
    return (f"CASE WHEN {wc} IS NOT NULL AND {wc} <> 0 THEN "
            f"CAST(greatest(1, round_even({wc} / {float(wpm)}, 0)) AS INTEGER) END")
