"""What is looked up, searched and joined for each text: as little as the results allow, and the same results."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from textforge.functions import clean as C
from textforge.functions.patterns import WS_RUN
from textforge.operators import phrases as P
from textforge.operators import tagger as G
from textforge.operators.entities import RULES, rule_entities


def test_texts_with_the_mark_keep_their_matches(spark):
    texts = [f"{C.MARK}5 days ago{C.MARK}", f"USD 5{C.MARK} 12:30 pm", C.MARK, "", None, "no match", "5% yesterday 7%"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", rule_entities(F.col("t")).alias("e")).collect()
    for r in got:
        assert r.t is None and r.e is None or [(e.text, e.type, e.start_char, e.end_char) for e in r.e] == [
            (m[0], k, m.start(), m.end()) for k, p in RULES for m in re.finditer(p, r.t)]


def test_texts_without_marks_are_not_split_by_a_rule(spark):
    """A split by a pattern is a second search: it stands in the branch of texts that hold the mark only."""
    df = spark.createDataFrame([("x",)], "t string").repartition(2)
    plan = df.select(rule_entities(F.col("t")).alias("e"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f", {C.MARK}, -1)") == len(RULES)


def test_a_word_is_looked_up_once(monkeypatch):
    seen, look = [], P.places_of
    monkeypatch.setattr(P, "places_of", lambda keys, state: seen.append(len(state)) or look(keys, state))
    keys = np.array([P.step(np.zeros(1, np.uint64), np.array([P.word_lanes("york", 1)[k]], np.uint64), k)[0] for k in (0, 1)])
    table = {"seed": 1, "keys": keys[:1], "check": keys[1:], "first": np.array([0, 1]), "types": np.array([0], np.int32), "names": ["GPE"]}
    got = P.find_hits(["\n old  york, by (york) ", None, "", "york"] * 500, table)
    assert got[:4] == [[{"type": "GPE", "start_char": 7, "end_char": 11}, {"type": "GPE", "start_char": 17, "end_char": 21}], [], [], [{"type": "GPE", "start_char": 0, "end_char": 4}]]
    assert seen == [6, 500]  # "no word" and the five that differ as they stand; then the 500 places where a word follows "york,"


def test_tags_as_from_the_features_of_each_word():
    r, rng = random.Random(5), np.random.default_rng(5)
    words = ["Ann", "(Ann)", "of", "Ulm,", "--", "12", "é", "paid", "$5.", "x"]
    texts = [r.choice(["", " ", "\n"]) + r.choice([" ", " ", "  ", "\t"]).join(r.choices(words, k=r.randint(0, 12))) for _ in range(300)] + [None, "", "  "]
    names = G.label_names(["GPE", "PERSON"])
    model = {"names": names, "bits": 10, "weights": rng.normal(size=(1 << 10, 5)).astype(np.float32), "trans": rng.normal(size=(5, 5)), "start": rng.normal(size=5), "trained": True}
    follow, begin = G.allowed(names)
    want = []
    for t in texts:
        spans = G.word_spans(t)
        emit = model["weights"].astype(np.float64)[G.Encoder(10).features([[t[a:b] for a, b in spans]])].sum(axis=1) if spans else np.zeros((0, 5))
        labels = G.viterbi(emit, np.array([len(spans)]), model["trans"] + follow, model["start"] + begin)
        want.append(G.found_spans(t, spans, [names[x] for x in labels]) if spans else [])
    assert G.tag_lists(texts, model).to_pylist() == want and sum(map(len, want)) > 300


def test_byte_tests_let_no_text_past_its_search(spark):
    chars = [chr(c) for c in (*range(1, 0x180), *range(0x1670, 0x1690), *range(0x2000, 0x2070), 0x3000, 0x1F600)]
    df = spark.createDataFrame([(f"a{x}{y}b",) for x in chars for y in ("", " ", x)] + [(" a",), ("",), (None,)], "t string")
    t = F.col("t")
    plain = [F.regexp_replace(t, r"(?s)<.*?>", " "), F.trim(F.regexp_replace(t, WS_RUN, " ")), F.regexp_replace(t, r"([.,!?\-])\1+", "$1")]
    gated = [C.remove_html_tags(t), C.normalize_whitespace(t), C.remove_excessive_punctuation(t)]
    for a, b in zip(plain, gated):
        assert df.filter(~a.eqNullSafe(b)).collect() == []
    plan = df.select(gated[1].alias("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan


def test_rows_at_one_place_meet_as_in_a_join(spark, tmp_dir):
    """Orders that stand twice: each true entity meets each one found, without a join of all entities."""
    import datetime

    from textforge.plans.q_entities import entity_tagger_orders

    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")

    save("region", [(i, f"REGION_{i}") for i in range(2)], "r_regionkey int, r_name string")
    save("nation", [(i, f"NATION_{i}", i % 2) for i in range(9)], "n_nationkey int, n_name string, n_regionkey int")
    save("customer", [(i, f"Customer#{i:09}", i % 9) for i in range(60)], "c_custkey long, c_name string, c_nationkey int")
    save("supplier", [(1, "Supplier#1")], "s_suppkey long, s_name string")
    day = datetime.datetime(2020, 5, 6)
    orders = [(i, i % 60, 100.0 + i, day) for i in range(240)]
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"
    save("orders", orders, schema)
    once = {r.ent_type: r for r in entity_tagger_orders(spark, tmp_dir).collect()}
    spark.createDataFrame(orders, schema).write.mode("append").parquet(f"{tmp_dir}/orders.parquet")
    df = entity_tagger_orders(spark, tmp_dir)
    twice = {r.ent_type: r for r in df.collect()}
    assert once["PERSON"].n_unseen > 0 and once["MONEY"].n_true > 0
    for kind in ("MONEY", "TIME", "PERCENT"):  # found wherever they are, not held out
        assert once[kind].n_right == once[kind].n_true and twice[kind].n_true == 4 * once[kind].n_true
    assert twice["PERSON"].n_unseen == 8 * once["PERSON"].n_unseen or once["PERSON"].n_unseen_right < once["PERSON"].n_unseen
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def one_step_after_another(texts, params, names, bits, batch):
    """The perceptron's updates as they are defined: a batch is labelled by the weights that the ones before left."""
    may_follow, may_start = G.allowed(names)
    params, steps = [p.copy() for p in params], 1
    late = [np.zeros_like(p) for p in params]
    encoder = G.Encoder(bits)
    for at in range(0, len(texts), batch):
        part = texts[at : at + batch]
        feats, lengths, gold = encoder.features([w for w, _ in part]), np.array([len(w) for w, _ in part]), np.concatenate([g for _, g in part])
        got = G.viterbi(params[0][feats].sum(axis=1), lengths, params[1] + may_follow, params[2] + may_start)
        first = np.cumsum(lengths) - lengths
        for sign, labels in ((1.0, gold), (-1.0, got)):
            for i in range(len(gold)):
                if gold[i] != got[i]:
                    for f in feats[i]:
                        params[0][f, labels[i]] += sign
                        late[0][f, labels[i]] += sign * steps
                where = (2, labels[i]) if i in first else (1, (labels[i - 1], labels[i]))
                params[where[0]][where[1]] += sign
                late[where[0]][where[1]] += sign * steps
        steps += 1
    return G.flat(params), G.flat([p - d / steps for p, d in zip(params, late)])


def labelled(r, n):
    """Texts of made-up names and the entities in them; some overlap, some are of a type that is not learned."""
    out = []
    for _ in range(n):
        words = r.choices(["Ann", "(Bob)", "of", "Ulm,", "--", "12", "paid", "x"], k=r.randint(0, 12))
        text, found = r.choice(["", " ", "\n"]) + r.choice([" ", "  "]).join(words), []
        for i, j in G.word_spans(text):
            if text[i:j] in ("Ann", "(Bob)") and r.random() < 0.9:
                found.append({"type": "PERSON", "start_char": i, "end_char": j})
            elif text[i:j] == "Ulm,":
                found.append({"type": r.choice(["GPE", "GPE", "NONE"]), "start_char": max(0, i - r.choice([0, 0, 4])), "end_char": j - 1})
        out.append((text, found))
    return out


def test_a_pass_is_one_step_after_another():
    """Right texts are labelled many at once: the same weights and means as batch by batch, and the same labels from entities."""
    import pyarrow as pa

    r, names, bits = random.Random(7), G.label_names(["GPE", "PERSON"]), 9
    number = {n: i for i, n in enumerate(names)}
    texts = labelled(r, 400)
    y, size = len(names), (1 << bits) * len(names) + len(names) ** 2 + len(names)
    start = G.unflat(np.array([r.choice([0.0, 0.0, 0.5, -1.0]) for _ in range(size)]), bits, y)
    want = []
    for text, found in texts:
        spans = G.word_spans(text)
        if spans:
            want.append(([text[i:j] for i, j in spans], np.array(G.gold_labels(spans, found, number))))
    kind = pa.list_(pa.struct([("type", pa.string()), ("start_char", pa.int32()), ("end_char", pa.int32())]))
    batch = pa.record_batch({"shard": pa.array([0] * 402, pa.int32()), "text": pa.array([None, *(t for t, _ in texts), ""]), "entities": pa.array([None, *(e for _, e in texts), []], kind)})
    now = G.Pass(start, names, 3)
    row = G.packed(batch, number, bits)
    lengths, ids, gold, table = G.unpacked(*(row.column(i)[0].as_py() for i in range(1, 5)), bits, y)
    assert lengths.tolist() == [len(w) for w, _ in want] and gold.tolist() == np.concatenate([g for _, g in want]).tolist()
    now.learn(lengths, ids, gold, table)
    assert np.allclose(now.ends_and_means(), one_step_after_another(want, start, names, bits, 3))


def test_all_labelled_texts_are_learned_from(spark):
    """More than 20,000 texts: what only those with the greatest hashes of their ids show is learned, too."""
    ids = spark.range(20_300).orderBy(F.xxhash64(F.col("id").cast("string")))
    last = {r.id for r in ids.tail(300)}
    rows = [(i, f"seen by Ann{i % 7} in Ulm", [("PERSON", 8, 12)]) if i in last else (i, "seen by nobody at all", []) for i in range(20_300)]
    docs = spark.createDataFrame(rows, "id long, t string, e array<struct<type:string,start_char:int,end_char:int>>")
    model = G.train(docs, "id", "t", "e", ["PERSON"], rounds=2, shards=3, bits=10)
    assert G.tag(["seen by Ann3 in Ulm"], model) == [[{"type": "PERSON", "start_char": 8, "end_char": 12}]]


def test_shards_are_summed_in_parts(spark, monkeypatch):
    """Five shards, two at a time: the model of one sum."""
    rows = [(i, t, [tuple(e.values()) for e in found]) for i, (t, found) in enumerate(labelled(random.Random(2), 200))]
    docs = spark.createDataFrame(rows, "id long, t string, e array<struct<type:string,start_char:int,end_char:int>>")
    fit = lambda: G.train(docs, "id", "t", "e", ["GPE", "PERSON"], rounds=2, shards=5, bits=9)
    whole = fit()
    monkeypatch.setattr(G, "PART", 2)
    parts = fit()
    for k in ("weights", "trans", "start"):
        assert np.allclose(whole[k], parts[k], atol=1e-5) and whole[k].any()
