import numpy as np
import pytest

from textforge.llm.common import rolling, word_hashes
from textforge.llm.decontaminate import alnum_words, decontaminate, winnow


def brute(docs, items, window=10):
    out = {}
    for doc, text in docs:
        w = alnum_words((text or "").encode())
        hit, names = set(), set()
        for item, t in items:
            v = alnum_words((t or "").encode())
            n = min(window, len(v))
            grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in grams:
                    hit.update(range(s, s + n))
                    names.add(item)
        out[doc] = (len(w), len(hit), sorted(names))
    return out


def check(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, len int")
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r.items)) for r in decontaminate(d, i, **kw).collect()}
    assert got == brute(docs, [x for x in items if x[0] is not None], **({"window": kw["window"]} if "window" in kw else {}))


def test_small_cases(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, item.upper()), (2, "zero " + item + " end"), (3, None), (4, ""), (5, "a b"), (6, "Ä-ö x a b c"), (7, "one two three four five six seven eight nine"),
            (8, ("a " * 40) + item[:60] + " " + item), (9, "w " * 5000), (10, "ten eleven twelve " + item)]
    items = [(1, item), (2, "a b"), (3, None), (4, ""), (5, "a a a"), (6, item), (None, "w w"), (7, "ä ö"), (8, "Ä ö")]
    check(spark, docs, items)


@pytest.mark.parametrize("docs,items", [([], []), ([(1, "a b c")], []), ([], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    check(spark, docs, items)


def test_random_texts(spark):
    rng = np.random.default_rng(5)
    text = lambda n: " ".join(rng.choice(list("abcd"), n))
    check(spark, [(i, text(rng.integers(0, 120))) for i in range(60)], [(i, text(rng.integers(0, 30))) for i in range(25)])
    check(spark, [(i, text(rng.integers(0, 60))) for i in range(40)], [(i, text(rng.integers(0, 9))) for i in range(15)], window=4, k=3)


def test_winnowing_keeps_a_place_in_every_window():
    rng = np.random.default_rng(6)
    for n in range(0, 60):
        h = rolling(word_hashes([bytes([x]) for x in rng.integers(97, 100, n)]), 2)
        at = winnow(h, 5)
        for i in range(max(0, len(h) - 4)):
            part = h[i : i + 5]
            assert i + int(part.argmin()) in at
