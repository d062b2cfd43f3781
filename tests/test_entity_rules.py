"""Rule matches with offsets: as by Python's own search, found by one search for each rule."""

import random
import re

from pyspark.sql import functions as F

from textforge.operators.entities import RULES, rule_entities

PARTS = ["yesterday", "last Friday", "Next ", "week", "May 5, 2024", "12 March 2020", "2024-01-02", "1/2/2024", "5 days ago", "12:30", " pm", "USD 5. 2", "€5", "$ 7.50",
         "£3", "5 EUR", "8%", " 9 percent", " ", " ", ". ", ",", "x", "1", "Maybe", "Tomorrow"]


def test_rules_as_python_finds_them(spark):
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 9))) for _ in range(2000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", rule_entities(F.col("t")).alias("e")).collect()
    for row in got:
        assert [(e.text, e.type, e.start_char, e.end_char) for e in row.e] == [(m[0], k, m.start(), m.end()) for k, p in RULES for m in re.finditer(p, row.t, re.ASCII)]
    assert sum(len(row.e) for row in got) > 2000


def test_one_search_a_rule(spark):
    df = spark.createDataFrame([("x",)], "t string").repartition(2)
    plan = df.select(rule_entities(F.col("t")).alias("e"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == len(RULES)


def test_texts_that_hold_no_part_of_a_match_are_not_searched(spark):
    """The same matches as by plain search, from texts with and without what the tests look for; the tests stand before the searches."""
    import random

    from textforge.operators.entities import HOLDS

    r = random.Random(8)
    pieces = ["last", "next", "This", "week", "month.", "year", "Monday", "Sunday,", "yesterday", "Today", "tomorrow", "to", "day", "May", "Sept.", "5", "2020", "5,", "3rd",
              "days", "ago", "12:30", "7", "pm", "AM", "USD", "EUR", "GBP", "$", "£", "€", "5.5", "%", "percent", "7%", "word", " é ", "2020-01-02", "1/2/2020"]
    texts = [" ".join(r.choices(pieces, k=r.randint(0, 4))) for _ in range(3000)] + [p + q for p in pieces for q in pieces] + [None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", rule_entities(F.col("t")).alias("e")).collect()
    for x in rows:
        assert x.t is None and x.e is None or [(e.text, e.type, e.start_char, e.end_char) for e in x.e] == [
            (m[0], k, m.start(), m.end()) for k, p in RULES for m in re.finditer(p, x.t, re.ASCII)]
    assert {e.type for x in rows if x.e for e in x.e} == set(HOLDS) == {k for k, _ in RULES}
    df = spark.createDataFrame([("x",)], "t string").repartition(2)
    plan = df.select(rule_entities(F.col("t")).alias("e"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") >= 13 and plan.count("RLIKE") == 2
