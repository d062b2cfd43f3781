"""Language identification by character-trigram rank profiles.

Out-of-place distance (Cavnar & Trenkle 1994). The whole text is lower-cased and every run of non-letters becomes one
space. A profile is the ``top_k`` most frequent trigrams with ranks (count desc, then trigram). Distance(doc, lang) = sum
over the document's profile of |rank_doc - rank_lang|, or ``top_k`` when the trigram is not in the language profile.
Integers only, so ties are exact; ties go to the alphabetically first language. A document sharing no trigram with any
profile is undetected (null), as is a text shorter than ``min_chars`` characters.

A document stays one row: its trigrams are counted and ranked within an Arrow batch, beside the profiles, which have
languages x ``top_k`` rows and are collected only below ``MAX_PROFILE_ROWS``. Training adds up counts per task first.

Confidence: the lead of the best language over the second, as a share of the largest distance possible, falls into one of
``LEADS`` + 1 steps. On labelled rows that no profile was made of, the share of right answers by step is made to rise with the lead
(isotonic regression by pooling neighbours); that share is the confidence of the step. Only one row for each step leaves Spark.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from textforge._ship import by_value

by_value(__name__)

TOP_K = 300
MIN_CHARS = 10
MAX_PROFILE_ROWS = 1_000_000
LEADS = 200
LOW = 0x3000  # code points that are looked up in a table
_SPACE = np.uint64(32)


def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(LOW)] + [False])


def trigram_keys(text: str, letters: np.ndarray) -> np.ndarray:
    """The trigrams of a text as numbers that sort like them, 21 bits for a character; letters (any combining mark is none) and
    single spaces."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(c) < 3:
        return np.zeros(0, np.uint64)
    letter = letters[np.minimum(c, LOW)]
    for high in np.unique(c[c >= LOW]).tolist():
        if chr(high).isalpha():
            letter |= c == high
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first of a run of others
    t = np.where(letter, c, _SPACE)[keep]
    return (t[:-2] << np.uint64(42)) | (t[1:-1] << np.uint64(21)) | t[2:]


def gram_strings(keys: np.ndarray) -> list[str]:
    chars = np.stack([(keys >> np.uint64(s)) & np.uint64(0x1FFFFF) for s in (42, 21, 0)], axis=1).astype(np.uint32)
    return np.ascontiguousarray(chars).view("<U3").ravel().tolist()


def gram_key(gram: str) -> int:
    a, b, c = map(ord, gram)
    return a << 42 | b << 21 | c


def profile_keys(keys: np.ndarray, top_k: int) -> np.ndarray:
    """The ``top_k`` most frequent of them, by count and then in order."""
    distinct, n = np.unique(keys, return_counts=True)
    return distinct[np.argsort(-n, kind="stable")[:top_k]]


def train_profiles(labelled: DataFrame, text_col: str, lang_col: str, top_k: int = TOP_K) -> DataFrame:
    """(lang, gram, rank) for the top_k trigrams of each language."""
    def count(batches):
        letters = letter_table()
        for batch in batches:
            by_lang: dict[str | None, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is not None:
                    by_lang.setdefault(lang, []).append(np.unique(trigram_keys(text, letters), return_counts=True))
            for lang, found in by_lang.items():
                keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n for _, n in found]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(gram_strings(keys), pa.string()), pa.array(n)], names=["lang", "gram", "cnt"])

    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(count, "lang string, gram string, cnt long").groupBy("lang", "gram").agg(F.sum("cnt").alias("cnt"))
    w = Window.partitionBy("lang").orderBy(F.col("cnt").desc(), F.col("gram"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k).drop("cnt")


def _detector(docs: DataFrame, profiles: DataFrame, top_k: int, min_chars: int):
    """text -> (language, lead) or (None, None)."""
    rows = profiles.select("lang", "gram", "rank").limit(MAX_PROFILE_ROWS + 1).collect()
    if len(rows) > MAX_PROFILE_ROWS:
        raise ValueError(f"more than {MAX_PROFILE_ROWS} profile rows; lower top_k or the number of languages")
    rows = [r for r in rows if r.lang is not None and r.gram is not None and len(r.gram) == 3]
    names = sorted({r.lang for r in rows})
    grams = np.array([gram_key(r.gram) for r in rows], np.uint64)
    order = np.argsort(grams, kind="stable")
    number = {name: i for i, name in enumerate(names)}
    langs, ranks = (np.array(x, np.int64)[order] for x in ([number[r.lang] for r in rows], [r.rank for r in rows]))
    shared = docs.sparkSession.sparkContext.broadcast((grams[order], langs, ranks, letter_table()))

    def detect(text: str | None) -> tuple[str | None, int | None]:
        if text is None or len(text.strip(" ")) < min_chars:
            return None, None
        grams, langs, ranks, letters = shared.value
        profile = profile_keys(trigram_keys(text, letters), top_k)
        first, last = np.searchsorted(grams, profile, "left"), np.searchsorted(grams, profile, "right")
        n = last - first
        total = int(n.sum())
        if not total:
            return None, None
        place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(total)  # all languages' ranks of each trigram
        rank = np.repeat(np.arange(1, len(profile) + 1), n)
        gains = np.bincount(langs[place], top_k - np.abs(rank - ranks[place]), len(names))
        met = np.bincount(langs[place], minlength=len(names))
        gain = {i: int(gains[i]) for i in range(len(names)) if met[i]}
        best, *rest = sorted(gain, key=lambda i: (-gain[i], i))[:2]
        return names[best], LEADS * (gain[best] - (gain[rest[0]] if rest else 0)) // (top_k * len(profile))

    return detect


def detect_language(docs: DataFrame, text_col: str, profiles: DataFrame, top_k: int = TOP_K,
                    out_col: str = "language", min_chars: int = MIN_CHARS, lead_col: str | None = None,
                    calibration: DataFrame | None = None, least_confidence: float = 0.0) -> DataFrame:
    """Adds ``out_col`` (null when too short or undetected), and ``lead_col`` if it is named.

    With a ``calibration`` (``calibrate``), a ``confidence`` is added, and answers below ``least_confidence`` become null."""
    detect = _detector(docs, profiles, top_k, min_chars)

    @pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("lead", T.IntegerType())]))
    def language(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([detect(t) for t in texts], columns=["lang", "lead"]).astype({"lead": "Int32"})

    # nondeterministic only so that Catalyst does not copy the call
    found = docs.withColumn("_found", language.asNondeterministic()(F.col(text_col)))
    if calibration is not None:
        steps = {r.lead: r.confidence for r in calibration.collect()}  # LEADS + 1 rows
        table = F.array(*[F.lit(steps[i]) for i in range(LEADS + 1)])
        found = found.withColumn("confidence", F.get(table, F.col("_found.lead")))
        sure = F.col("confidence") >= least_confidence
        found = found.withColumn(out_col, F.when(sure, F.col("_found.lang")))
    else:
        found = found.withColumn(out_col, F.col("_found.lang"))
    if lead_col:
        found = found.withColumn(lead_col, F.col("_found.lead"))
    return found.drop("_found")


def pooled(right: list[int], seen: list[int]) -> list[float | None]:
    """Isotonic regression of right / seen by pooling neighbours; steps without rows take the step below (None: there is none)."""
    blocks: list[list[int]] = []  # right, seen, last step
    for i, (r, n) in enumerate(zip(right, seen)):
        if n:
            blocks.append([r, n, i])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                r, n, last = blocks.pop()
                blocks[-1] = [blocks[-1][0] + r, blocks[-1][1] + n, last]
    out: list[float | None] = []
    for i in range(len(seen)):
        if seen[i]:
            out.append(next(b[0] / b[1] for b in blocks if b[2] >= i))
        else:
            out.append(out[-1] if out else None)
    return out


def calibrate(scored: DataFrame, lang_col: str, found_col: str, lead_col: str) -> DataFrame:
    """(lead, confidence) for every step, from rows with a language that the profiles were not made of; steps below all rows have 0."""
    steps = scored.filter(F.col(lead_col).isNotNull() & F.col(lang_col).isNotNull()).groupBy(F.col(lead_col).alias("lead")).agg(
        F.count_if(F.col(lang_col) == F.col(found_col)).alias("right"), F.count("*").alias("seen"))
    got = {r.lead: r for r in steps.collect()}  # LEADS + 1 rows at most
    right, seen = ([got[i][c] if i in got else 0 for i in range(LEADS + 1)] for c in ("right", "seen"))
    rows = [(i, 0.0 if c is None else c) for i, c in enumerate(pooled(right, seen))]
    return scored.sparkSession.createDataFrame(rows, "lead int, confidence double")
