import re

import pytest

from textforge.llm.license_scan import BASE, NOTICES, scan

SCHEMA = "doc_id long, text string, label string, pos int, h long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base_places(text):
    w = words(text)
    return [(i, label) for phrase, label in BASE.items() for i in range(len(w)) if w[i : i + len(p := phrase.split())] == p]


TEXTS = ["", None, "CC-BY and cc by; all   Rights RESERVED", "x " * 3000 + "General Public License cc", "by cc", "cc", "cc by cc by",
         "Licensed under the Apache License, Version 2.0", "licensed under the new Apache License version 2.0 all rights",
         "nothing é here", "all rights all rights reserved", "K ccKby licenſe"]


def test_base_places_against_brute_force(spark):
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        places, r = base_places(t), got[i]
        assert (r.n_words, r.n_base) == (len(words(t)), len(places)), t
        assert r.first_word == min((p for p, _ in places), default=None)
        assert r.last_word == max((p for p, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    assert got[7].labels == "apache-notice" and got[7].score == 1
    assert got[8].labels == "" or got[8].score < 1  # two of six k-grams are broken by the word put in
    assert got[9].labels == "" and got[9].score == 0


def test_neighbouring_diagonals_merge(spark):
    text = "redistribution and use in source and binary forms with or without any modification are permitted provided that the following conditions are met"
    r = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert r.labels == "bsd-text" and 0.8 <= r.score < 1 and r.spans[0].start == 0


def test_notices_with_one_edit_are_found(spark):
    """Every word of every notice changed, left out, or preceded by another one."""
    rows, want = [], []
    for phrase, label in NOTICES.items():
        w = phrase.split()
        for i in range(len(w)):
            for new in (w[:i] + ["Other"] + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + ["other"] + w[i:]):
                if label == "mit-notice" and "mit" not in new:  # another licence
                    continue
                rows.append((len(rows), " ".join(["before", *new, "and", "after"])))
                want.append((label, 1.0 if len(new) > len(w) and i == 0 else (len(w) - 1) / len(w)))
    for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert (want[r.doc_id][0], want[r.doc_id][1]) in [(s.label, s.score) for s in r.spans], rows[r.doc_id]
    got = scan(spark.createDataFrame([(1, TEXTS[8]), (2, "licensed under a mit style license and the mit license"), (3, "Licensed under the BSD license")], "doc_id long, text string"))
    assert {r.doc_id: r.labels for r in got.collect()} == {1: "apache-notice", 2: "", 3: ""}


@pytest.mark.parametrize("rows", [[], [(None, "cc by"), (3, "a cc by"), (3, "cc by b")]])
def test_empty_null_and_repeated_ids(spark, rows):
    got = {r.doc_id: (r.n_words, r.n_base) for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == ({None: (2, 1), 3: (6, 2)} if rows else {})


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan(docs).collect()}
    for r in docs.collect():
        p = base_places(r.text)
        assert got[r.doc_id] == (len(words(r.text)), len(p), min((x for x, _ in p), default=None), max((x for x, _ in p), default=None), ",".join(sorted({x for _, x in p})))
