"""Every stage on its own input, and the whole run, against plain Python."""


import numpy as np
import pytest

import corpus_pipeline as P
from tests.llm.test_decontaminate import brute
from tests.llm.test_ngram_join import edited, sample
from tests.llm.test_ngram_join import expected as components_of
from tests.llm.test_suffix_dedup import expected as bytes_of

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s%d" % (i % 3), len(t or "")) for i, (d, t) in enumerate(rows)], SCHEMA)


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "substrings", "decontamination", "packing"]


def test_language_stage_rejects_only_texts_without_a_language(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "12 34 !", "de", "s", 7), (9003, "", None, "s", 0), (None, "the of", "en", "s", 6)], SCHEMA)
    out = P.language_id(spark, docs.select(*P.COLUMNS).union(odd), SF)
    assert out.columns == P.COLUMNS
    assert texts(out) == texts(docs)


def test_near_duplicates_stage(spark):
    rows = [r for r in sample(11) if r[0] is not None]
    kept = {d for d, _, c in components_of(rows, 5, 80) if d == c}
    out = P.near_duplicates(spark, documents(spark, rows), SF)
    assert out.columns == P.COLUMNS and texts(out) == sorted((d, t) for d, t in rows if d in kept)


def test_substring_stage(spark):
    rng = np.random.default_rng(12)
    base = ["é%d" % x for x in range(200)]
    rows = [(i, edited(rng, base[rng.integers(0, 60) :], 6)) for i in range(20)] + [(50, ""), (51, None)]
    out = P.substrings(spark, documents(spark, rows), SF)
    want = sorted((d, kept.decode("utf-8", "ignore")) for d, *_, kept in bytes_of(rows, 100))
    assert out.columns == P.COLUMNS and texts(out) == want
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_decontamination_stage(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    rows = [(1, items[0][1]), (2, "clean text"), (3, "x " + " ".join(items[1][1].split()[:12]) + " y"), (4, None)]
    kept = {d for d, (_, n, _) in brute(rows, items).items() if not n}
    assert texts(P.decontamination(spark, documents(spark, rows), SF)) == sorted((d, t) for d, t in rows if d in kept)


def test_run_keeps_what_the_stages_keep(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(SF + "/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    rows = [(d, docs[d]) for d, _, c in components_of(sorted(docs.items()), 5, 80) if d == c]
    rows = [(d, kept.decode("utf-8", "ignore")) for d, *_, kept in bytes_of(rows, 100)]
    hit = brute(rows, items)
    want = {d for d, _ in rows if not hit[d][1]}
    out = P.run(spark, SF).collect()
    assert {r.doc_id for r in out} == want
    assert all(r.offset + r.length <= 2048 for r in out)


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_empty_and_null_rows(spark, stage):
    empty = spark.createDataFrame([], SCHEMA)
    assert stage(spark, empty, SF).collect() == []
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "text", "en", "s", 4), (2, "", "en", None, 0), (2, "the and of", None, "s", 10)], SCHEMA)
    stage(spark, odd, SF).collect()
