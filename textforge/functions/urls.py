"""URL repair, as Column expressions (scalars and arrays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textforge.functions.patterns import WS

# Scheme typos and their repair, applied in this order.
SCHEME_FIXES = (
    ("https.://", "https://"),
    ("http.://", "http://"),
    ("httpss://", "https://"),
    ("httpps://", "https://"),
)


def strip_ws(col: Column) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(col, f"^{WS}+|{WS}+$", "")


def sanitize_url(col: Column) -> Column:
    """Trim, fix scheme typos, add ``https://`` to bare domains; null if unfixable."""
    u = strip_ws(col)
    for bad, good in SCHEME_FIXES:
        u = F.replace(u, F.lit(bad), F.lit(good))
    has_scheme = u.startswith("http://") | u.startswith("https://")
    fixed = (
        F.when(has_scheme, u)
        .when(u.contains(".") & ~u.startswith("//"), F.concat(F.lit("https://"), u))
    )
    return F.when(col.isNotNull() & (col != ""), fixed)


def sanitize_url_array(col: Column) -> Column:
    """Repair each URL, drop unfixable ones, empty list -> null."""
    arr = F.filter(F.transform(col, sanitize_url), lambda x: x.isNotNull())
    return F.when(F.size(arr) > 0, arr)


# Structural URL check standing in for the typed model's HttpUrl: scheme, optional user part, a host without spaces or
# delimiters (international names and underscores are hosts too), optionally a port, then path/query.
HTTP_URL_PATTERN = r"^https?://(?:[^\s/?#@]*@)?(?:\[[0-9A-Fa-f:.]+\]|[\p{L}\p{N}](?:[\p{L}\p{N}\p{M}._-]*[\p{L}\p{N}\p{M}])?)\.?(?::[0-9]{1,5})?(?:[/?#][^\s]*)?$"


def is_http_url(col: Column) -> Column:
    return col.rlike(HTTP_URL_PATTERN)
