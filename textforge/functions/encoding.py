"""Encoding repair.

Native part (every row, inside codegen): curly quotes straightened, Latin
ligatures expanded, full-width ASCII folded, control characters dropped.

Python part (only rows a native ``rlike`` flags): HTML entities, mojibake
(UTF-8 read as cp1252/latin-1), stray C1 controls and NFC normalisation. Rows
the gate rejects reach the Arrow UDF as nulls, so their text never crosses
into Python.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Quote characters folded to ASCII (single, then double).
CURLY_SINGLE = "ʼ‘’‚‛"
CURLY_DOUBLE = "“”„‟"
# Latin ligatures and their expansions.
LIGATURES = (
    ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"),
    ("ﬅ", "st"), ("ﬆ", "st"), ("Ĳ", "IJ"), ("ĳ", "ij"), ("ŉ", "'n"),
    ("Ǆ", "DŽ"), ("ǅ", "Dž"), ("ǆ", "dž"), ("Ǉ", "LJ"), ("ǈ", "Lj"),
    ("ǉ", "lj"), ("Ǌ", "NJ"), ("ǋ", "Nj"), ("ǌ", "nj"), ("Ǳ", "DZ"), ("ǲ", "Dz"), ("ǳ", "dz"),
)
# Full-width ASCII variants U+FF01..U+FF5E map 1:1 onto U+0021..U+007E; the
# ideographic space U+3000 becomes a plain space.
FULLWIDTH_SRC = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
FULLWIDTH_DST = "".join(chr(c) for c in range(0x21, 0x7F)) + " "
# Control characters removed (tab, newline, form feed, CR are kept).
CONTROL_PATTERN = r"[\x00-\x08\x0B\x0E-\x1F\x7F\x{FFF9}-\x{FFFC}]"

# Rows whose repair needs Python: HTML entities, C1 controls, probable
# mojibake pairs, combining marks (NFC).
_MOJIBAKE_TAIL = (
    r"\x{80}-\x{BF}\x{152}\x{153}\x{160}\x{161}\x{178}\x{17D}\x{17E}\x{192}\x{2C6}\x{2DC}"
    r"\x{2013}\x{2014}\x{2018}-\x{201E}\x{2020}-\x{2022}\x{2026}\x{2030}\x{2039}\x{203A}\x{20AC}\x{2122}"
)
NEEDS_PYTHON = (
    r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});?"
    r"|[\x{80}-\x{9F}]"
    rf"|[\x{{C2}}-\x{{F4}}][{_MOJIBAKE_TAIL}]"
    r"|\p{M}"
)

_MOJIBAKE_RUN = re.compile(
    "[Â-ô][\u0080-¿ŒœŠšŸŽžƒˆ˜"
    "–—‘-„†-•…‰‹›€™]+"
)
_C1 = re.compile("[\u0080-\u009f]")


def _to_bytes(s: str) -> bytes | None:
    out = bytearray()
    for ch in s:
        try:
            out += ch.encode("cp1252")
        except UnicodeEncodeError:
            o = ord(ch)
            if o < 256:
                out.append(o)  # bytes cp1252 leaves undefined decode as latin-1
            else:
                return None
    return bytes(out)


def _fix_run(m: re.Match) -> str:
    raw = _to_bytes(m.group(0))
    if raw is None:
        return m.group(0)
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return m.group(0)


def _c1(m: re.Match) -> str:
    try:
        return bytes([ord(m.group(0))]).decode("cp1252")
    except UnicodeDecodeError:
        return ""


def fix_text_python(s: str | None) -> str | None:
    """Per-row helper for the gated rows (small and dependency free)."""
    if s is None:
        return None
    if "<" not in s and "&" in s:
        s = html.unescape(s)
    for _ in range(2):  # doubly encoded text needs a second round
        fixed = _MOJIBAKE_RUN.sub(_fix_run, s)
        if fixed == s:
            break
        s = fixed
    s = _C1.sub(_c1, s)
    s = unicodedata.normalize("NFC", s)
    return _fix_native_py(s)


def _fix_native_py(s: str) -> str:
    # Same as the native part; keeps Python-repaired text consistent.
    s = s.translate({ord(c): "'" for c in CURLY_SINGLE} | {ord(c): '"' for c in CURLY_DOUBLE})
    for a, b in LIGATURES:
        s = s.replace(a, b)
    s = s.translate(str.maketrans(FULLWIDTH_SRC, FULLWIDTH_DST))
    return re.sub("[\x00-\x08\x0b\x0e-\x1f\x7f￹-￼]", "", s)


@pandas_udf(T.StringType())
def _fix_text_udf(s: pd.Series) -> pd.Series:
    return s.map(fix_text_python, na_action="ignore")


# Nondeterministic only to keep Catalyst from duplicating the call into filters.
_fix_text_udf = _fix_text_udf.asNondeterministic()


# Rows that the native part changes: any of the characters above. One range passes the printable characters of ASCII.
NEEDS_NATIVE = r"(?![ -~])(?:[" + "".join(
    rf"\x{{{ord(c):X}}}" for c in CURLY_SINGLE + CURLY_DOUBLE + "".join(a for a, _ in LIGATURES)
) + r"\x{FF01}-\x{FF5E}\x{3000}]|" + CONTROL_PATTERN + ")"


def fix_encoding_native(col: Column) -> Column:
    return F.get(F.transform(F.array(col), lambda x: F.when(x.rlike(NEEDS_NATIVE), _fix_native(x)).otherwise(x)), 0)


def _fix_native(col: Column) -> Column:
    c = F.translate(col, CURLY_SINGLE + CURLY_DOUBLE, "'" * len(CURLY_SINGLE) + '"' * len(CURLY_DOUBLE))
    for a, b in LIGATURES:
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.translate(c, FULLWIDTH_SRC, FULLWIDTH_DST)
    return F.regexp_replace(c, CONTROL_PATTERN, "")


def fix_encoding(col: Column) -> Column:
    """Native repair for every row; Arrow UDF only where the gate fires."""
    gated = F.get(F.transform(F.array(col), lambda x: F.when(x.rlike(NEEDS_PYTHON), x)), 0)
    return F.coalesce(_fix_text_udf(gated), fix_encoding_native(col))


from textforge._ship import by_value  # noqa: E402

by_value(__name__)
