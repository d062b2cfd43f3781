"""T1-T7 against a brute-force edit-1-then-edit-2 search on a small fixture."""

import itertools

from pyspark.sql import functions as F

from textforge.config import CleaningConfig
from textforge.operators.typo import correct_typos, correction_map, damerau_levenshtein, swap_distance, tokens_of

CFG = CleaningConfig.settings_default()
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def edits1(w):
    splits = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    return set(
        [a + b[1:] for a, b in splits if b]
        + [a + b[1] + b[0] + b[2:] for a, b in splits if len(b) > 1]
        + [a + c + b[1:] for a, b in splits if b for c in LETTERS]
        + [a + c + b for a, b in splits for c in LETTERS]
    )


def brute(word, freq):
    e1 = [w for w in edits1(word) if w in freq]
    if not e1:
        e1 = list({w2 for w in edits1(word) for w2 in edits1(w) if w2 in freq})
    if not e1:
        return None
    return sorted(e1, key=lambda w: (-freq[w], w))[0]


def test_distance():
    assert damerau_levenshtein("ca", "abc") == 2
    assert damerau_levenshtein("teh", "the") == 1
    assert damerau_levenshtein("kitten", "sitting") == 3


def test_candidates_match_brute_force(spark):
    freq = {"the": 100, "apple": 20, "quick": 15, "brown": 12, "fox": 30, "there": 9, "then": 9, "than": 8,
            "house": 7, "horse": 7, "mouse": 3, "abc": 2, "spelling": 4, "correct": 5}
    unknown = ["teh", "appel", "qick", "brwn", "fxo", "thn", "hose", "ca", "speling", "corect", "zzzz", "thre"]
    d = spark.createDataFrame(list(freq.items()), "word string, freq long")
    u = spark.createDataFrame([(w,) for w in unknown], "word string")
    got = {r.word: r.correction for r in correction_map(u, d, CFG).collect()}
    for w in unknown:
        b = brute(w, freq)
        if b is not None and abs(len(b) - len(w)) > CFG.typo_max_len_diff:
            b = None
        assert got.get(w) == b, (w, got.get(w), b)


def test_correct_text_rules(spark):
    words = {"the": 50, "apple": 10, "san": 3, "can": 40, "this": 9, "is": 30, "a": 40, "test": 5, "with": 20,
             "typos": 2, "like": 8, "and": 45, "in": 35, "quick": 4, "brown": 3, "fox": 2, "ate": 2, "an": 20,
             "mixed": 2}
    d = spark.createDataFrame(list(words.items()), "word string, freq long")
    docs = spark.createDataFrame([
        (1, "Teh quick brown fox ate an appel.", None),
        (2, "This is a test with typos like teh and appel in San Francisco", ["san", "francisco"]),
        (3, "Mixed iPhone McDonalds TEH", None),
    ], "id int, t string, ew array<string>")
    out = {r.id: r.t for r in correct_typos(docs, "id", "t", d, CFG, "ew").collect()}
    assert out[1].startswith("The quick") and out[1].endswith("appel.")
    assert "the and apple in San Francisco" in out[2]
    assert out[3] == "Mixed iPhone McDonalds TEH"


def test_tokens_are_those_of_str_split(spark):
    """One search a text: every kind of white space, at the ends, alone, and none."""
    texts = ["", " ", "a", " a b  c\t", "\x1c a \x85b　", "a-b !~ é ü", "​ x", "\n\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "id int, t string")
    got = {r.id: r.a for r in rows.select("id", tokens_of(F.col("t")).alias("a")).collect()}
    assert got == {**{i: t.split() for i, t in enumerate(texts)}, len(texts): None}


def test_swaps_are_told_for_a_whole_batch():
    """Against the distance itself, over pairs of every kind that are passed on."""
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abc", repeat=n)]
    pairs = [(v, w) for v in words[::3] for w in words[::2] if abs(len(v) - len(w)) <= 1]
    for (v, w), d in zip(pairs, swap_distance([v for v, _ in pairs], [w for _, w in pairs])):
        exact = damerau_levenshtein(v, w)
        assert d >= min(exact, 3) or v == w, (v, w)  # never less than the distance
        if d == 3 and exact <= 2:  # then letters replaced, added or dropped alone reach it
            assert sum(x != y for x, y in zip(v, w)) <= 2 or exact == 1 or _levenshtein(v, w) <= 2, (v, w)


def _levenshtein(a, b):
    row = [*range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]
