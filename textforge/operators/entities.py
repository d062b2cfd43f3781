"""Entity tagging with character offsets.

(a) Gazetteer: an automaton over words finds all phrases of a ``(phrase, type)`` table in one pass of the text
    (``phrases``).
(b) Rules: DATE / TIME / MONEY / PERCENT regexes, matched in-row.
(c) Model: a trained sequence tagger (``tagger``), if one is given.

Gazetteer tokens are the words between white space, with leading/trailing punctuation stripped. Rule offsets come from
one search that marks the matches, and the pieces between marks, folded in one ``aggregate`` pass. Offsets are code points, end exclusive. Overlaps: candidates are ordered by (start, longer first,
type); a candidate is dropped when a kept one reaches past its start (one ``aggregate``).

Rules, phrases and model give candidates alike; the overlap rule decides between them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.config import DEFAULT_ENTITY_TYPES
from textforge.functions.clean import MARK, bound
from textforge.operators.phrases import with_phrases
from textforge.operators.tagger import spans_udf

# Leading/trailing characters stripped from a word to get its token.
EDGE_PUNCT = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
LEAD_PUNCT = r"^[^\p{L}\p{N}]+"

# Month and weekday names recognised by the DATE rules.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December")
MONTH_ABBR = ("Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Sept", "Oct", "Nov", "Dec")
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

_MONTH = "(?:" + "|".join(MONTHS + MONTH_ABBR) + r")\.?"
_WD = "(?:" + "|".join(WEEKDAY_NAMES) + ")"
RULES: tuple[tuple[str, str], ...] = (
    ("DATE", r"\b(?:" + _MONTH + r" [0-9]{1,2}(?:st|nd|rd|th)?,? [0-9]{4}"
             r"|[0-9]{1,2} " + _MONTH + r" [0-9]{4}"
             r"|[0-9]{4}-[0-9]{2}-[0-9]{2}"
             r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
             r"|[0-9]+ (?:days?|weeks?|months?|years?) ago"
             r"|(?:[Ll]ast|[Nn]ext|[Tt]his) (?:week|month|year|" + _WD + ")"
             r"|[Yy]esterday|[Tt]oday|[Tt]omorrow|" + _WD + r")\b"),
    ("TIME", r"\b[0-9]{1,2}(?::[0-9]{2})? ?(?:[ap]m|[AP]M)\b|\b[0-9]{1,2}:[0-9]{2}\b"),
    ("MONEY", r"(?:\b(?:USD|EUR|GBP) [0-9]+(?:[.,] ?[0-9]+)*|\$ ?[0-9]+(?:[.,][0-9]+)*|£ ?[0-9]+(?:[.,][0-9]+)*"
              r"|\b[0-9]+(?:[.,] ?[0-9]+)* ?(?:EUR\b|€))"),
    ("PERCENT", r"\b[0-9]+(?:\. ?[0-9]+)? ?(?:percent\b|%)"),
)

# The characters that the matches of each rule begin with: looked at first, as word boundaries and alternatives cost far more.
INITIALS = {"DATE": "[0-9ADFJLMNOSTWYlnty]", "TIME": "[0-9]", "MONEY": "[0-9EGU$£]", "PERCENT": "[0-9]"}

# What every match of a rule holds one of: a text without any is not searched, as these tests cost far less.
DIGIT = "[0-9]"
HOLDS = {"DATE": (DIGIT, "day", "morrow", "week", "month", "year"), "TIME": (DIGIT,), "MONEY": ("$", "£", "€", "USD ", "EUR", "GBP "), "PERCENT": ("%", "percent")}

ENTITY_TYPE = "struct<text:string,type:string,start_char:int,end_char:int>"


def _sum_lengths(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0), lambda acc, s: acc + F.length(s))


def regex_spans(text: Column, pattern: str, etype: str) -> Column:
    """All matches of ``pattern`` as entity structs with offsets."""
    pattern = f"(?={INITIALS[etype]})(?:{pattern})" if etype in INITIALS else pattern
    none = F.array().cast(f"array<{ENTITY_TYPE}>")

    def entity(s: Column, start: Column) -> Column:
        return F.struct(s.alias("text"), F.lit(etype).alias("type"), start.cast("int").alias("start_char"), (start + F.length(s)).cast("int").alias("end_char"))

    def by_marks(x: Column) -> Column:
        """One search sets a mark at both ends of each match; every second piece between marks is a match."""
        init = F.struct(F.lit(0).alias("pos"), F.lit(False).alias("inside"), none.alias("out"))
        step = lambda acc, s: F.struct((acc["pos"] + F.length(s)).alias("pos"), (~acc["inside"]).alias("inside"),
                                       F.when(acc["inside"], F.array_append(acc["out"], entity(s, acc["pos"]))).otherwise(acc["out"]).alias("out"))
        spans = lambda m: F.when(~m.contains(MARK), none).otherwise(F.aggregate(F.split(m, MARK, -1), init, step)["out"])
        return bound(F.regexp_replace(x, pattern, f"{MARK}$0{MARK}"), spans)

    def by_pieces(x: Column) -> Column:
        init = F.struct(F.lit(0).alias("pos"), none.alias("out"))

        def step(acc, e):
            st = acc["pos"] + F.length(e["s"])
            return F.struct((st + F.length(e["x"])).alias("pos"), F.array_append(acc["out"], entity(e["x"], st)).alias("out"))

        def spans(m: Column) -> Column:
            z = F.arrays_zip(F.slice(F.split(x, pattern, -1), 1, F.size(m)).alias("s"), m.alias("x"))
            return F.when(F.size(m) == 0, none).otherwise(F.aggregate(z, init, step)["out"])

        return bound(F.regexp_extract_all(x, F.lit(pattern), 0), spans)

    def searched(x: Column) -> Column:
        # texts that hold the mark themselves are searched twice: for the matches and for what stands between them
        found = F.when(x.contains(MARK), by_pieces(x)).otherwise(by_marks(x))
        holds = [x.rlike(h) if h == DIGIT else x.contains(h) for h in HOLDS.get(etype, ())]
        return F.when(~reduce(Column.__or__, holds), none).otherwise(found) if holds else found

    return bound(text, searched)


def rule_entities(text: Column) -> Column:
    arrs = [regex_spans(text, pat, t) for t, pat in RULES]
    return F.concat(*arrs)


def phrase_key(phrase: Column) -> Column:
    """Gazetteer key: whitespace words with edge punctuation stripped, single-spaced."""
    words = F.split(F.trim(F.regexp_replace(phrase, r"\s+", " ")), " ")
    return F.array_join(F.filter(F.transform(words, lambda w: F.regexp_replace(w, EDGE_PUNCT, "")),
                                 lambda w: w != ""), " ")


def gazetteer_table(pairs: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Union of (dataframe, name column, type) into (key, type, n_tokens)."""
    out = None
    for df, col, etype in pairs:
        part = df.select(F.col(col).cast("string").alias("phrase"), F.lit(etype).alias("type"))
        out = part if out is None else out.unionByName(part)
    key = phrase_key(F.col("phrase"))
    return (out.select("type", key.alias("key")).filter(F.col("key") != "")
            .withColumn("n_tokens", F.size(F.split("key", " "))).dropDuplicates(["key", "type"]))


def resolve_overlaps(cands: Column) -> Column:
    """Order by (start, longer first, type); drop a candidate reached by an earlier one that is kept."""
    srt = F.array_sort(cands, lambda a, b: F.when(a["start_char"] != b["start_char"],
                                                  F.when(a["start_char"] < b["start_char"], -1).otherwise(1))
                       .when(a["end_char"] != b["end_char"], F.when(a["end_char"] > b["end_char"], -1).otherwise(1))
                       .when(a["type"] < b["type"], -1).when(a["type"] > b["type"], 1).otherwise(0))
    init = F.struct(F.lit(-1).alias("maxend"), F.array().cast(f"array<{ENTITY_TYPE}>").alias("out"))
    return F.aggregate(srt, init, lambda acc, e: F.struct(
        F.when(acc["maxend"] > e["start_char"], acc["maxend"]).otherwise(e["end_char"]).alias("maxend"),
        F.when(acc["maxend"] > e["start_char"], acc["out"]).otherwise(F.array_append(acc["out"], e)).alias("out"),
    ))["out"]


def tag_entities(docs: DataFrame, id_col: str, text_col: str, gazetteer: DataFrame | None,
                 types: tuple[str, ...] | None = DEFAULT_ENTITY_TYPES, out_col: str = "entities", model: dict | None = None) -> DataFrame:
    """Adds ``out_col``: array of entity structs on ``text_col`` (E1, E2): rules, phrases of the gazetteer, and what a trained
    ``model`` (``tagger.train``) finds."""
    cands = rule_entities(F.col(text_col))
    untexted = lambda h: F.struct(F.lit(None).cast("string").alias("text"), h["type"].alias("type"), h["start_char"].alias("start_char"), h["end_char"].alias("end_char"))
    if gazetteer is not None:
        docs = with_phrases(docs, id_col, text_col, gazetteer, "_hits")
        cands = F.concat(cands, F.transform("_hits", untexted))
    if model is not None:
        docs = docs.withColumn("_found", spans_udf(docs.sparkSession, model)(F.col(text_col)))
        cands = F.concat(cands, F.transform("_found", untexted))
    kept = resolve_overlaps(cands)
    with_text = F.transform(kept, lambda e: F.struct(
        F.substring(F.col(text_col), e["start_char"] + 1, e["end_char"] - e["start_char"]).alias("text"),
        e["type"].alias("type"), e["start_char"].cast("int").alias("start_char"),
        e["end_char"].cast("int").alias("end_char")))
    if types is not None:
        tl = F.array(*[F.lit(t) for t in types])
        with_text = F.filter(with_text, lambda e: F.array_contains(tl, e["type"]))
    return docs.withColumn(out_col, with_text).drop("_hits", "_found")


def entity_words(entities: Column) -> Column:
    """E3 -> T7: lower-cased words of all entity texts (for typo protection)."""
    return F.array_distinct(F.flatten(F.transform(
        entities, lambda e: F.split(F.lower(F.trim(e["text"])), r"\s+"))))


def first_date_text(entities: Column, fallback: Column) -> Column:
    """Text of the first DATE entity, else the whole cleaned text."""
    d = F.filter(entities, lambda e: e["type"] == "DATE")
    return F.coalesce(F.try_element_at(d, F.lit(1))["text"], fallback)
