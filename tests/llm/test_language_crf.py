import itertools
import zlib

import numpy as np
import pytest

from textforge.llm.language_crf import LETTERS, Emissions, exponentials, identify, letter_words, marginals, predict, ragged_marginals, train

SCHEMA = "doc_id long, text string, lang string, score string, held_out int"


def by_paths(emit, trans, start):
    t, y = emit.shape
    total, p = 0.0, np.zeros((t, y))
    for path in itertools.product(range(y), repeat=t):
        s = np.exp(start[path[0]] + sum(emit[i, l] for i, l in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        total += s
        for i, l in enumerate(path):
            p[i, l] += s
    return p / total


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    trans, start = rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = np.array([4, 1, 6, 2, 6, 3])
    emit = rng.normal(size=(lengths.sum(), 3)) * 2
    mean, each = ragged_marginals(exponentials(emit), np.arange(len(emit)), lengths, trans, start, True)
    at = 0
    for i, n in enumerate(lengths):
        p = by_paths(emit[at : at + n], trans, start)
        assert np.allclose(each[at : at + n], p) and np.allclose(mean[i], p.mean(axis=0))
        assert np.allclose(marginals(emit[None, at : at + n], trans, start)[0][0], p)
        at += n


def test_long_chains_keep_their_scale():
    """Factors are scaled every few steps only; sharp scores over 400 words give what scaling at each step gives."""
    rng = np.random.default_rng(2)
    trans, start = rng.normal(size=(4, 4)) * 3, rng.normal(size=4)
    emit = rng.normal(size=(800, 4)) * 25
    lengths = np.array([400, 3, 397])
    _, each = ragged_marginals(exponentials(emit), np.arange(800), lengths, trans, start, True)
    for at, n in ((0, 400), (400, 3), (403, 397)):
        assert np.allclose(each[at : at + n], marginals(emit[None, at : at + n], trans, start)[0][0])


def test_generations_of_words_change_nothing():
    rng = np.random.default_rng(3)
    model = {"labels": ["a", "b"], "bits": 10, "lexicon_bits": 8, "weights": rng.normal(size=(1 << 10, 2)).astype(np.float32), "lexicon": rng.normal(size=(1 << 8, 2)).astype(np.float32)}
    whole, small = Emissions(model), Emissions(model)
    for _ in range(8):
        words = [f"w{n}" if n % 3 else f"é{n}" for n in rng.zipf(1.3, 300) % 1000]
        assert (whole.rows[whole.numbers(words)] == small.rows[small.numbers(words)]).all()
        small.next_generation()


@pytest.mark.parametrize("text", ["Plain Words, 12 and_more x" + "y" * 95, "tab\tand\x00nul é Größe" + "ü" * 90, "", " \n1", "I'm a-b"])
def test_words_of_ascii_and_other_texts(text):
    assert letter_words(text.encode()) == LETTERS.findall(text.lower())


def test_held_out_accuracy_and_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = [(10_001, None, "en", "x", 1), (10_002, "", "de", "x", 1), (10_003, "123 !? _ 45", "fr", "x", 1), (None, "the", "en", "x", 1), (10_004, "the of and", None, "x", 1), (10_004, "die und der", None, "x", 1)]
    both = docs.selectExpr("doc_id", "text", "lang", "source as score", "1 as held_out").union(spark.createDataFrame(extra, SCHEMA))
    got = [(r.doc_id, r.held_out, r.lang_pred, r.score) for r in identify(both, sample_rows=80).collect()]
    assert len(got) == docs.count() + 5
    lang = {r.doc_id: r.lang for r in docs.collect()}
    right = [lang[d] == p for d, h, p, _ in got if d in lang and h]
    assert len(right) > 100 and sum(right) / len(right) > 0.98
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= s <= 1 for d, h, _, s in got)
    assert sorted((p, s) for d, _, p, s in got if 10_001 <= d <= 10_003) == [("und", 0.0)] * 3
    assert len([1 for d, *_ in got if d == 10_004]) == 2


@pytest.mark.parametrize("rows,out", [([], []), ([(1, "some words", None, "x", 1)], [(1, "und", 0.0)]), ([(2, "one two", "en", "x", 1)], [(2, "en", 1.0)])])
def test_few_rows(spark, rows, out):
    got = identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.doc_id, r.lang_pred, round(r.score, 9)) for r in got] == out


def test_switch_of_language_within_a_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs.select("doc_id", "text", "lang"), sample_rows=80)
    half = {r.lang: " ".join(r.text.split()[:60]) for r in docs.filter("n_chars > 1000").collect()}
    mixed = spark.createDataFrame([(1, half["es"] + " " + half["de"])], "doc_id long, text string")
    spans = predict(mixed, model, with_spans=True).collect()[0].spans
    assert spans[0].lang == "es" and spans[-1].lang == "de" and len(spans) <= 8
    assert sum(s.words for s in spans) == spans[-1]["first"] + spans[-1].words


def test_text_without_separators_is_read_to_its_end(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs.select("doc_id", "text", "lang"), sample_rows=80)
    glued = {r.lang: "".join(letter_words(r.text.encode()))[:2000] for r in docs.filter("n_chars > 3000").collect()}
    rows = [(1, glued["es"][:40] + glued["de"]), (2, glued["de"][:40] + glued["es"])]
    got = predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "de", 2: "es"}
    assert "".join(letter_words(rows[0][1].encode())) == rows[0][1] and max(map(len, letter_words(rows[0][1].encode()))) == 40
