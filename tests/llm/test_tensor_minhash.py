import numpy as np
import pytest

from textforge.llm.tensor_minhash import collection_values, near_dedup
from tests.llm.test_ngram_join import edited, expected, sample

SCHEMA = "doc_id long, text string, n long, a string, vals int, key int"


def run(spark, rows, size=3, percent=85, **kw):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(3)
    got = near_dedup(docs, size, percent, **kw).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in got)


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 85), (4, 2, 90)])
def test_against_brute_force(spark, seed, size, percent):
    rows = sample(seed)
    assert run(spark, rows, size, percent) == expected(rows, size, percent)


def test_group_of_near_copies_at_all_distances(spark):
    """Copies of one text with 0 to 20 edits: links within the group, but few of all its pairs."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(d, edited(rng, base, rng.integers(0, 20))) for d in range(160)]
    assert run(spark, rows) == expected(rows, 3, 85)


def test_links_beside_a_page_that_holds_the_passage(spark):
    """Copies of a passage link; pages that hold it with as much again are leaders of an unfit size."""
    rng = np.random.default_rng(6)
    base, other = [f"a{i}" for i in range(120)], [f"b{i}" for i in range(120)]
    rows = [(d, edited(rng, base, 2)) for d in range(10, 60)] + [(d, " ".join(base + other[: 10 * d])) for d in range(1, 10)]
    assert run(spark, rows) == expected(rows, 3, 85)


def test_exact_bound_counts_as_a_link(spark):
    words = [f"w{i}" for i in range(102)]  # 100 shingles
    same = words[:87]  # 85 of them: 85 / 100
    less = words[:86]
    assert run(spark, [(1, " ".join(words)), (2, " ".join(same))]) == [(1, 100, 1), (2, 85, 1)]
    assert run(spark, [(1, " ".join(words)), (2, " ".join(less))]) == [(1, 100, 1), (2, 84, 2)]


def test_agreement_of_collections_follows_the_similarity():
    """Two collections of four minhashes agree with the fourth power of the similarity; 80 minhashes, 190 tables."""
    rng = np.random.default_rng(0)
    agree = []
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 170, dtype=np.uint64)
        x, y = (np.concatenate([both, rng.integers(0, 1 << 63, 15, dtype=np.uint64)]) for _ in range(2))  # similarity 0.85
        v = collection_values([x, y], 20, 4)
        agree.append((v[0] == v[1]).sum())
    assert abs(np.mean(agree) / 20 - 0.85**4) < 0.02
    assert min(agree) >= 2


def test_one_text_in_most_rows_and_long_texts(spark):
    long_text = " ".join(f"v{i % 40_000}" for i in range(100_000))
    rows = [(d, "same words in a third of all rows") for d in range(200)] + [(900, long_text), (901, long_text + " end"), (902, "one"), (903, "ONE"), (904, "one two")]
    assert run(spark, rows) == expected(rows, 3, 85)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a b c d")], [(2, "a b c d e f"), (1, "a b c d e f")], [(1, ""), (2, " \t")]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == expected(rows, 3, 85)


def test_repeated_ids_give_one_row(spark):
    got = run(spark, [(1, "a b c d e f"), (1, "other words"), (2, "a b c d e f"), (2, "a b c d e f")])
    assert [d for d, *_ in got] == [1, 2]
