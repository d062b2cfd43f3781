"""The phrase automaton against plain search, the tagger against all paths and on entities it never saw."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from textforge.operators import tagger as G
from textforge.operators.entities import gazetteer_table, tag_entities
from textforge.operators.phrases import bare, find_hits, states_of, table_of, with_phrases


def plain_hits(text, phrases):
    spans = [m.span() for m in re.finditer(r"\S+", text or "")]
    bares = [(a + bare(text[a:b])[0], a + bare(text[a:b])[1]) for a, b in spans]
    out = []
    for i in range(len(bares)):
        for key, kind in phrases:
            n = len(key.split(" "))
            if [text[a:b] for a, b in bares[i : i + n]] == key.split(" "):
                out.append((kind, bares[i][0], bares[i + n - 1][1]))
    return sorted(out)


PHRASES = [("new york", "GPE"), ("new york city", "GPE"), ("york", "GPE"), ("york", "PERSON"), ("a b a b", "ORG"), ("b a", "ORG"), ("x1", "ORG"), ("é ü", "GPE")]


def gazetteer(spark, phrases=PHRASES):
    return spark.createDataFrame([(k, t, len(k.split(" "))) for k, t in phrases], "key string, type string, n_tokens int")


@pytest.mark.parametrize("most_states", [1000, 3])
def test_all_phrases_against_plain_search(spark, most_states):
    """Nested, overlapping and repeated phrases, in one table and in parts."""
    rng = np.random.default_rng(4)
    pieces = ["new", "york", "city", "a", "b", "(x1)", "é", "ü,", "-", " ", "york.", "new,york", "\n", "x1x"]
    rows = [(i, " ".join(rng.choice(pieces, rng.integers(0, 30)))) for i in range(60)] + [(100, None), (101, ""), (102, "a b " * 5000), (103, "--- ...")]
    docs = spark.createDataFrame(rows, "id int, t string").repartition(3)
    got = {r.id: sorted((h.type, h.start_char, h.end_char) for h in r.hits) for r in with_phrases(docs, "id", "t", gazetteer(spark), "hits", most_states).collect()}
    assert got == {i: plain_hits(t, PHRASES) for i, t in rows}


def test_empty_gazetteer_and_table(spark):
    docs = spark.createDataFrame([(1, "new york")], "id int, t string")
    assert with_phrases(docs, "id", "t", gazetteer(spark, []).limit(0), "hits").first().hits == []
    assert with_phrases(docs.limit(0), "id", "t", gazetteer(spark), "hits").collect() == []


def test_table_of_many_phrases_stays_small(spark):
    """300,000 phrases of three words: some 20 bytes for each state, found again one by one."""
    g = spark.range(300_000).select(F.concat_ws(" ", F.concat(F.lit("p"), F.col("id") % 1000), F.concat(F.lit("q"), F.col("id") % 77_000), F.concat(F.lit("r"), F.col("id"))).alias("key"), F.lit("ORG").alias("type"))
    table = table_of(states_of(g, 1), 1)
    n = len(table["keys"])
    assert 300_000 < n < 700_000 and sum(table[k].nbytes for k in ("keys", "check", "first", "types")) < 30 * n
    got = find_hits([f"see p{i % 1000} q{i % 77_000} r{i}, p{i % 1000} q{i % 77_000}" for i in range(0, 300_000, 5003)], table)
    assert all(len(h) == 1 and h[0]["start_char"] == 4 for h in got)


def best_path(emit, trans, start):
    y = emit.shape[1]
    score = lambda p: start[p[0]] + sum(emit[i, l] for i, l in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))
    return max(itertools.product(range(y), repeat=len(emit)), key=score)


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    names = G.label_names(["A"])
    follow, begin = G.allowed(names)
    trans, start = rng.normal(size=(3, 3)) + follow, rng.normal(size=3) + begin
    lengths = np.array([4, 0, 1, 7, 2, 7, 0])
    emit = rng.normal(size=(lengths.sum(), 3)) * 2
    got, at = G.viterbi(emit, lengths, trans, start), 0
    for n in lengths:
        if n:
            assert tuple(got[at : at + n]) == best_path(emit[at : at + n], trans, start)
        at += n


def sentence(rng, person, place):
    forms = ["{p} from {l} wrote a letter.", "Yesterday {p} left ({l}) for good.", "In {l}, {p} met nobody today.", "A letter reached {l} and then {p} again."]
    return str(rng.choice(forms)).format(p=person, l=place)


def test_entities_outside_the_gazetteer_are_found(spark):
    """Names and places held out of the gazetteer: F1 above 0.9, offsets equal to the text."""
    rng = np.random.default_rng(3)
    name = lambda ends: "".join(rng.choice(list("bdklmnrst")) + rng.choice(list("aeiou")) for _ in range(rng.integers(2, 4))).title() + str(rng.choice(ends))
    people = sorted({f"Mr. {name(['son', 'sen'])} {name(['ski', 'er'])}" for _ in range(80)})
    places = sorted({name(["burg", "ville"]) for _ in range(80)})
    known = gazetteer_table([(spark.createDataFrame([(p,) for p in people[::2]], "n string"), "n", "PERSON"), (spark.createDataFrame([(p,) for p in places[::2]], "n string"), "n", "GPE")])
    rows = [(i, sentence(rng, people[2 * int(rng.integers(0, len(people) // 2))], places[2 * int(rng.integers(0, len(places) // 2))])) for i in range(400)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "id int, t string")
    labelled = tag_entities(docs, "id", "t", known, types=("PERSON", "GPE"))
    model = G.train(labelled, "id", "t", "entities", ["PERSON", "GPE"], rounds=3, shards=3, bits=14)
    right = found = wanted = 0
    test = [(i, people[2 * int(rng.integers(0, (len(people) - 1) // 2)) + 1], places[2 * int(rng.integers(0, (len(places) - 1) // 2)) + 1]) for i in range(200)]
    texts = {i: sentence(rng, p, l) for i, p, l in test}
    got = tag_entities(spark.createDataFrame(list(texts.items()), "id int, t string"), "id", "t", None, types=("PERSON", "GPE"), model=model).collect()
    truth = {i: {(p.removeprefix("Mr. "), "PERSON"), (l, "GPE")} for i, p, l in test}
    for r in got:
        assert all(r.t[e.start_char : e.end_char] == e.text for e in r.entities)
        mine = {(e.text.removeprefix("Mr. "), e.type) for e in r.entities}
        right, found, wanted = right + len(mine & truth[r.id]), found + len(mine), wanted + 2
    assert 2 * right / (found + wanted) > 0.9


def test_no_labelled_rows(spark):
    docs = spark.createDataFrame([(1, None)], "id int, t string").withColumn("e", F.array().cast("array<struct<type:string,start_char:int,end_char:int>>"))
    model = G.train(docs, "id", "t", "e", ["GPE"], rounds=1, shards=2, bits=8)
    assert G.tag(["some text", None, ""], model) == [[], [], []]


def test_labels_and_spans_are_inverse():
    text = "Mr. Ann Lee, (Ulm) and Bonn."
    spans, number = G.word_spans(text), {n: i for i, n in enumerate(G.label_names(["GPE", "PERSON"]))}
    entities = [{"type": "PERSON", "start_char": 4, "end_char": 11}, {"type": "GPE", "start_char": 14, "end_char": 17}, {"type": "GPE", "start_char": 23, "end_char": 27}]
    names = G.label_names(["GPE", "PERSON"])
    assert G.found_spans(text, spans, [names[i] for i in G.gold_labels(spans, entities, number)]) == entities
