from collections import Counter
from itertools import permutations

from textforge.llm.filter_audit import audit

DOCS = "doc_id long, text string, source string, mask int, digest string, good int"
LABELS = "doc_id long, quality int, toxic int, part string"


def brute_force(rows, labels):
    good, toxic = ({d for d, *x in labels if x[i] == 1 and d is not None} for i in (0, 1))
    firsts = {}
    for d, t, _ in rows:
        if d is not None:
            firsts[t or ""] = min(firsts.get(t or "", d), d)
    out = Counter()
    parts = set()
    for d, t, part in rows:
        t, part = t or "", part or ""
        w = t.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
        w = [x for x in w if x]
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": d is not None and firsts[t] < d}
        parts.add(part)
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, "".join(order), step)
                here = fails[f] and not gone
                for name, is_so in (("kept", not fails[f] and not gone), ("removed", here), ("redundant", fails[f] and gone), ("unique_fails", fails[f] and sum(fails.values()) == 1),
                                    ("good_lost", here and d in good), ("toxic_lost", here and d in toxic)):
                    out[key, name] += is_so
                out[(part, f), "shapley"] += here
                gone |= fails[f]
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return sorted((p, "".join(o), s, *[out[(p, "".join(o), s), n] for n in names], out[(p, o[s - 1]), "shapley"]) for p in parts for o in permutations("ABCDE") for s in range(1, 6))


def run(spark, rows, labels):
    docs = spark.createDataFrame([(d, t, s, 7, "x", 1) for d, t, s in rows], DOCS).repartition(3)
    marks = spark.createDataFrame([(*x, "y") for x in labels], LABELS)
    got = audit(docs, marks)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in got.collect())


def text(n, distinct=None, tail=""):
    return " ".join(f"word{i % (distinct or n)}" for i in range(n)) + tail


def test_against_brute_force(spark):
    rows = [
        (1, text(60), "a"), (2, text(60), "a"), (3, text(60), "b"), (3, text(60), "b"),  # copies, in another part, and a repeated row
        (4, text(60, 39), "a"), (5, text(60, 38), "a"), (6, text(100, 65), "b"), (7, text(100, 64, " #1"), "b"),  # at the bound of B
        (8, text(49), None), (9, text(50), ""), (10, None, None), (11, "", "a"), (12, " \t\n\x0b\x0c\r ", "a"),
        (13, "A" * 5 + "b" * 95, "a"), (14, "A" * 6 + "b" * 94, "a"), (15, "É" * 60 + "Ab", "a"),  # code points, not bytes
        (16, " ".join(["x"] * 60), "a"),  # no-break spaces separate nothing
        (17, "  " + text(50) + " \r\n", "b"), (18, text(300, 3, " A|B"), "b"), (19, "\x00 $ \x1f", "b"),
        (None, text(60), "a"), (None, None, None), (20, text(60, 39), None), (-5, text(100, 65), "b"), (21, "Word word", "c"), (22, "%" + text(30_000, 100) + " X" * 20_000, "c"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (5, None, 1), (7, 1, None), (11, 1, 1), (14, 1, 0), (22, 0, 1), (None, 1, 1), (999, 1, 1), (10, 2, 3)]
    assert run(spark, rows, labels) == brute_force(rows, labels)


def test_one_text_in_most_rows(spark):
    rows = [(i, text(60), f"s{i % 3}") for i in range(300)] + [(i, text(60) + f" t{i}", "s0") for i in range(300, 400)]
    assert run(spark, rows, []) == brute_force(rows, [])


def test_no_rows(spark):
    assert run(spark, [], [(1, 1, 1)]) == []
