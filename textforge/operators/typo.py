"""Dictionary typo correction as joins.

Work is paid once per *distinct unknown word*, not per token:

1. tokens (``split`` on whitespace, with positions) pass the eligibility rules:
   alphabetic, length in range, not an entity word of the document, not a
   capitalised word longer than 5, not ``Xx..X`` mixed case;
2. distinct lower-cased eligible tokens ``left_anti`` the dictionary;
3. candidates by symmetric deletes: both sides explode every string reachable
   by deleting up to two characters and equi-join on it (complete for edit
   distance <= 2, no cross join); the Damerau-Levenshtein tier of those pairs
   is decided natively where Levenshtein settles it, by an Arrow UDF otherwise
   (``with_distance``);
4. best = lowest distance, then highest frequency, then alphabetical, via a
   struct ``min`` (partial aggregation, no window sort);
5. accepted if ``|len diff| <= (1 - confidence) * 10``;
6. fixes are joined back per document by token position, keeping an upper-case
   first letter; the text is rebuilt with single spaces.

Steps 2 to 5 are for a word table that is given. ``noisy_channel`` learns from
the corpus which words are errors, and of which words; its table skips them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from textforge.config import CleaningConfig
from textforge.functions.patterns import WS


def damerau_levenshtein(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance (Lowrance-Wagner)."""
    la, lb = len(a), len(b)
    inf = la + lb
    d = [[0] * (lb + 2) for _ in range(la + 2)]
    d[0][0] = inf
    for i in range(la + 1):
        d[i + 1][0], d[i + 1][1] = inf, i
    for j in range(lb + 1):
        d[0][j + 1], d[1][j + 1] = inf, j
    last_row: dict[str, int] = {}
    for i in range(1, la + 1):
        last_match_col = 0
        for j in range(1, lb + 1):
            i1 = last_row.get(b[j - 1], 0)
            j1 = last_match_col
            cost = 1
            if a[i - 1] == b[j - 1]:
                cost, last_match_col = 0, j
            d[i + 1][j + 1] = min(
                d[i][j] + cost,
                d[i + 1][j] + 1,
                d[i][j + 1] + 1,
                d[i1][j1] + (i - i1 - 1) + 1 + (j - j1 - 1),
            )
        last_row[a[i - 1]] = i
    return d[la + 1][lb + 1]


def swap_distance(a: list[str], b: list[str]) -> np.ndarray:
    """For pairs at most one letter apart in length: 1 if one swap of neighbours makes them equal, 2 if a swap and one more edit do
    (a second swap, another letter, or a letter more before, after or between the swapped ones), else 3; all pairs at once."""
    n = max(map(len, a + b), default=0) + 2
    codes = lambda words: np.array(words, f"U{n}").view(np.uint32).reshape(-1, n)
    size = lambda words: np.array([*map(len, words)], np.int64)
    x, y, swap = codes(a), codes(b), size(a) > size(b)
    short, long = np.where(swap[:, None], y, x), np.where(swap[:, None], x, y)
    row, at = np.arange(len(a)), np.arange(n)

    def swaps(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where letters differ, and where two neighbours are swapped."""
        differ = u != v
        swapped = np.zeros_like(differ)
        swapped[:, :-1] = differ[:, :-1] & (u[:, :-1] == v[:, 1:]) & (u[:, 1:] == v[:, :-1])
        return differ, swapped

    def without(u: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.take_along_axis(u, np.minimum(at + (at >= place[:, None]), n - 1), axis=1)

    differ, swapped = swaps(short, long)
    count, any_swap = differ.sum(axis=1), swapped.any(axis=1)
    first, last = differ.argmax(axis=1), n - 1 - differ[:, ::-1].argmax(axis=1)
    two = (count == 4) & swapped[row, first] & swapped[row, np.maximum(last - 1, 0)] & (last - first >= 3)
    equal = np.where((count == 2) & any_swap, 1, np.where((count == 3) & any_swap | two, 2, 3))
    # one letter more: it stands at the first difference and the swap follows, or the swap is there and the letter follows
    d, s = swaps(short, without(long, first))
    before = (d.sum(axis=1) == 2) & s.any(axis=1)
    turned = short.copy()
    turned[row, first], turned[row, np.minimum(first + 1, n - 1)] = short[row, np.minimum(first + 1, n - 1)], short[row, first]
    after = (turned == without(long, (turned != long).argmax(axis=1))).all(axis=1)
    return np.where(size(a) == size(b), equal, np.where(before | after, 2, 3)).astype(np.int32)


@pandas_udf(T.IntegerType())
def swap_distance_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(a), 3, np.int32)
    asked = np.flatnonzero(a.notna().to_numpy() & b.notna().to_numpy())
    if len(asked):
        out[asked] = swap_distance(a.iloc[asked].tolist(), b.iloc[asked].tolist())
    return pd.Series(out)


def deletes_upto2(word: Column) -> Column:
    """All strings from deleting 0, 1 or 2 characters of ``word`` (distinct)."""
    n = F.length(word)
    rng = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))

    one = F.transform(rng, lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))
    two = F.flatten(F.transform(rng, lambda i: F.transform(
        F.sequence(i + 1, F.greatest(n, i + 1)),
        lambda j: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1, j - i - 1), F.substr(word, j + 1)))))
    return F.array_distinct(F.concat(F.array(word), F.when(n >= 1, one).otherwise(F.array()),
                                     F.when(n >= 2, two).otherwise(F.array())))


# Deletion keys this short are shared by very many words: they are dealt over salts.
SHORT_KEY, SALTS = 1, 16


def eligible(tok: Column, cfg: CleaningConfig, entity_words: Column | None = None) -> Column:
    n = F.length(tok)
    ok = tok.rlike(r"^\p{L}+$") & (n >= cfg.typo_min_length) & (n <= cfg.typo_max_length)
    if cfg.typo_use_ner and entity_words is not None:
        ok = ok & ~F.coalesce(F.array_contains(entity_words, F.lower(tok)), F.lit(False))
    if cfg.typo_skip_capitalized:
        ok = ok & ~(tok.rlike(r"^\p{Lu}") & (n > 5))
    if cfg.typo_skip_mixed_case:
        ok = ok & ~tok.rlike(r"^\p{Lu}.*\p{Lu}")
    return ok


def tokens_of(text: Column) -> Column:
    """Python ``str.split()``: whitespace runs, no empty tokens."""
    return F.array_remove(F.split(text, f"{WS}+"), "")  # empty ones stand at the ends only


def with_distance(pairs: DataFrame) -> DataFrame:
    """pairs (word, cand) with ``dist``: the Damerau-Levenshtein distance where it can be <= 2, else 3.

    Levenshtein (native, stops above 2) decides most pairs: DL = Lev when Lev <= 1; Lev = 2 is DL 1 exactly for one adjacent swap,
    else 2. Lev >= 3 pairs can still reach DL 2 through a swap, so their lengths differ by <= 1. Only where a swap can matter are
    words passed to Python (else nulls), where a batch is looked at at once.
    """
    word, cand, lev = F.col("word"), F.col("cand"), F.col("_lev")
    pairs = pairs.withColumn("_lev", F.levenshtein("word", "cand", 2))
    apart = F.abs(F.length(word) - F.length(cand))
    asked = ((lev == 2) & (apart == 0)) | ((lev < 0) & (apart <= 1))
    dist = F.least(F.when(lev < 0, 3).otherwise(lev), F.col("_swap"))
    return pairs.withColumn("_swap", swap_distance_udf(F.when(asked, word), F.when(asked, cand))).withColumn("dist", dist).drop("_lev", "_swap")


def correction_map(unknown: DataFrame, dictionary: DataFrame, cfg: CleaningConfig) -> DataFrame:
    """unknown(word) x dictionary(word, freq) -> (word, correction) for accepted fixes."""
    max_len = cfg.typo_max_length + 2
    dkeys = (dictionary.filter(F.length("word") <= max_len)
             .select(F.col("word").alias("cand"), "freq", F.explode(deletes_upto2(F.col("word"))).alias("key")))
    ukeys = unknown.select("word", F.explode(deletes_upto2(F.col("word"))).alias("key"))
    short = F.length("key") <= SHORT_KEY
    dkeys = dkeys.withColumn("salt", F.explode(F.when(short, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    ukeys = ukeys.withColumn("salt", F.when(short, F.pmod(F.hash("word"), F.lit(SALTS))).otherwise(F.lit(0)))
    pairs = ukeys.join(dkeys, ["key", "salt"]).select("word", "cand", "freq").distinct()
    pairs = pairs.filter(F.abs(F.length("word") - F.length("cand")) <= 2)
    scored = with_distance(pairs)
    # The distance test sits inside the aggregate (min ignores nulls): a
    # Filter on ``dist`` would be pushed below the projection and evaluate
    # the distance expression twice.
    best = scored.groupBy("word").agg(F.min(F.when(F.col("dist") <= 2, F.struct(
        F.col("dist"), (-F.col("freq")).alias("nfreq"), F.col("cand")))).alias("b"))
    best = best.filter(F.col("b").isNotNull()).select("word", F.col("b.cand").alias("correction"))
    limit = cfg.typo_max_len_diff
    return best.filter(F.abs(F.length("correction") - F.length("word")) <= F.lit(limit))


def _capitalize_like(tok: Column, correction: Column) -> Column:
    return F.when(tok.rlike(r"^\p{Lu}"),
                  F.concat(F.upper(F.substr(correction, F.lit(1), F.lit(1))), F.substr(correction, F.lit(2)))
                  ).otherwise(correction)


def correct_typos(df: DataFrame, id_col: str, text_col: str, dictionary: DataFrame,
                  cfg: CleaningConfig, entity_words_col: str | None = None, out_col: str | None = None,
                  lang_col: str | None = None) -> DataFrame:
    """Replace ``text_col`` (or write ``out_col``) with the typo-corrected text.

    ``dictionary`` is a word table (word, freq): unknown words get their best
    candidate. Or it is a learned one with a column ``correction``
    (``noisy_channel``): only the words it names are replaced, in texts of
    their language if ``lang_col`` is given; no candidates are searched here.

    ``df`` must be unique on ``id_col``. Per document only the *distinct*
    eligible lower-case words are exploded and joined with the correction map;
    the matches come back as a small word -> correction map per document and
    the text is rebuilt in-row (tokens re-checked for eligibility, so case
    rules apply per occurrence). The text is always re-joined with single
    spaces (the reference splits and joins even when nothing changes).
    """
    out_col = out_col or text_col
    ew = F.col(entity_words_col) if entity_words_col else None
    toks = tokens_of(F.col(text_col))
    if "correction" in dictionary.columns:
        # every word is looked up, and rules are asked only of those found, when the text is rebuilt
        words = F.array_distinct(F.split(F.lower(F.col(text_col)), f"{WS}+"))
    else:
        words = F.array_distinct(F.transform(F.filter(toks, lambda t: eligible(t, cfg, ew)), lambda t: F.lower(t)))
    by = ["lang", "word"] if lang_col else ["word"]
    langs = [F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang")] if lang_col else []
    per_doc_words = df.select(F.col(id_col).alias("_id"), *langs, F.explode(words).alias("word"))
    if "correction" in dictionary.columns:
        cmap = dictionary.filter(F.col("correction").isNotNull() & (F.abs(F.length("correction") - F.length("word")) <= F.lit(cfg.typo_max_len_diff))).select(*by, "correction")
    else:
        unknown = per_doc_words.select("word").distinct().join(dictionary.select("word"), "word", "left_anti")
        cmap = correction_map(unknown, dictionary, cfg)
    fixes = per_doc_words.join(cmap, by)
    per_doc = fixes.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "correction"))).alias("_fixes"))
    joined = df.join(per_doc, df[id_col] == per_doc["_id"], "left").drop("_id")
    fx = F.col("_fixes")

    def fix(t: Column) -> Column:
        c = F.try_element_at(fx, F.lower(t))
        return F.when(c.isNotNull() & eligible(t, cfg, F.col(entity_words_col) if entity_words_col else None),
                      _capitalize_like(t, c)).otherwise(t)

    rebuilt = F.array_join(F.transform(tokens_of(F.col(text_col)), fix), " ")
    return joined.withColumn(out_col, F.when(fx.isNull(), F.array_join(tokens_of(F.col(text_col)), " "))
                             .otherwise(rebuilt)).drop("_fixes")

from textforge._ship import by_value  # noqa: E402

by_value(__name__)
