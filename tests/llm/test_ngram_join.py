import numpy as np
import pytest

from textforge.llm.components import components
from textforge.llm.ngram_join import join_documents

SCHEMA = "doc_id long, text string, n long, a string, rep int"


def sets_of(rows, size):
    out = {}
    for d, t in rows:
        if d is not None:
            w = (t or "").encode().lower().split()
            out[d] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    return out


def expected(rows, size, percent):
    sets = sets_of(rows, size)
    at = {d: d for d in sets}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            if sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                at[b] = a
    return sorted((d, len(sets[d]), root(d)) for d in ids)


def run(spark, rows, size=5, percent=80, **kw):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in join_documents(docs, size, percent, **kw).collect())


def edited(rng, words, n):
    w = list(words)
    for p in rng.integers(0, len(w), n):
        kind = rng.integers(0, 3)
        if kind == 0:
            w[p % len(w)] = "new%d" % rng.integers(0, 10**6)
        elif kind == 1 and len(w) > 6:
            del w[p % len(w)]
        else:
            w.insert(p % len(w), "common%d" % rng.integers(0, 5))
    return " ".join(w)


def sample(seed, docs=150):
    rng = np.random.default_rng(seed)
    word = lambda: "w%d" % (rng.zipf(1.4) % 500)
    bases = [[word() for _ in range(rng.integers(5, 120))] for _ in range(6)]
    passage = [word() for _ in range(40)]
    rows = []
    for d in rng.permutation(docs) - 20:
        kind = rng.integers(0, 10)
        base = bases[0] if kind < 4 else bases[rng.integers(0, 6)]
        if kind < 8:
            rows.append((int(d), edited(rng, base, rng.integers(0, 1 + len(base) // 12))))
        elif kind == 8:
            rows.append((int(d), " ".join(passage + [word() for _ in range(rng.integers(0, 30))])))
        else:
            rows.append((int(d), " ".join(word() for _ in range(rng.integers(1, 50)))))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one Two"), (1004, "ONE two"), (1005, "one two three"), (None, "one two"), (1006, "a " * 3000), (1007, "a " * 40)]


@pytest.mark.parametrize("seed,size,percent", [(1, 5, 80), (3, 3, 80), (4, 2, 60), (5, 1, 70)])
def test_against_brute_force(spark, seed, size, percent):
    rows = sample(seed)
    assert run(spark, rows, size, percent, bucket_bytes=3000) == expected(rows, size, percent)


def test_links_whose_leader_has_an_unfit_size(spark):
    """All shared prefix shingles of the near copies 1 and 2 are led by 3, which is twice as long; its rest is more frequent."""
    text, other = [f"a{i}" for i in range(400)], [f"b{i}" for i in range(400)]
    change = lambda at: " ".join(text[:at] + [f"new{at}"] + text[at + 1 :])
    rows = [(1, change(100)), (2, change(300)), (3, " ".join(text + other))]
    rows += [(d, " ".join(other + [f"end{d}"])) for d in (4, 5, 6)]
    assert run(spark, rows) == expected(rows, 5, 80) == [(1, 396, 1), (2, 396, 1), (3, 796, 3), (4, 397, 4), (5, 397, 4), (6, 397, 4)]


def test_leaders_of_many_sizes_against_brute_force(spark):
    """Parts of few texts, of all sizes: pairs with one, two or no overlap counted with the leader."""
    rng = np.random.default_rng(11)
    bases = [[f"{b}-{i}" for i in range(300)] for b in range(4)]
    rows = [(i, " ".join(b)) for i, b in enumerate(bases)]
    for d in range(10, 170):
        b = bases[rng.integers(0, 4)]
        w = b[(at := int(rng.integers(0, 60))) : at + int(rng.integers(60, 240))]
        rows.append((d, edited(rng, w, rng.integers(0, 4))))
    assert run(spark, rows, bucket_bytes=3000) == expected(rows, 5, 80)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(2, "a b c d e f"), (1, "a b c d e f")]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == expected(rows, 5, 80)


def test_repeated_ids_give_one_row(spark):
    got = run(spark, [(1, "a b c d e f"), (1, "other words"), (2, "a b c d e f"), (2, "other words")])
    assert [d for d, *_ in got] == [1, 2]


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    hub = [(500, i) for i in range(501, 700)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 500 for i in range(500, 700)}}
