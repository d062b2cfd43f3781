"""Rules joined into few searches give what the rules give one by one, and no search is done twice."""

import random

from pyspark.sql import functions as F

from textforge.functions import clean as C

PARTS = ["$", "€", "£", " ", "  ", "\t", "\x1c", "5", "12", ".", "3.25", "٣", ",", "%", "m", "km", "kg", "cm", "ft", "lbs", "mi", "g", "usd", "us dollar", "us dollars",
         "UſD", "eur", "Euros", "gbp", "GBP", "pound", "poundsterling", "pounds", "sterling", "é", "_", "-", "—", "“", "́", "", "m", "x", ""]


def rows(spark, parts, n=3000):
    r = random.Random(7)
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(n)]
    return spark.createDataFrame([(t,) for t in [*texts, "1€os", "5%m", "3.5 %", "$5€", "£ 5.25€m", "5km3%"]] + [(None,)], "t string")


def test_joined_amount_rules(spark):
    df, t = rows(spark, PARTS), F.col("t")
    one_by_one = df.select("t", C.by_rules(t, C.CURRENCY_RULES).alias("c"), C.by_rules(t, C.unit_rules()).alias("u"),
                           C.by_rules(t, [*C.CURRENCY_RULES, *C.unit_rules()]).alias("b"))
    joined = one_by_one.select("*", C.standardize_currency(t).alias("c2"), C.standardize_units(t).alias("u2"), C.where_needed(
        t, C.AMOUNT_GATE, lambda x: C.marked(x, [*C.CURRENCY_RULES, *C.unit_rules()], [*C.CURRENCY_JOINED, *C.UNITS_JOINED])).alias("b2"))
    assert joined.filter("c <> u").count() > 500
    assert joined.filter("not (c <=> c2 and u <=> u2 and b <=> b2)").collect() == []


def test_amounts_take_few_searches():
    assert len(C.CURRENCY_JOINED) + len(C.UNITS_JOINED) == 4  # of 15 rules


def test_grep_cleans_once(spark, tmp_dir):
    from textforge.plans.q_clean import grep_currency_lineitem

    spark.range(9).selectExpr("id as l_orderkey", "cast(id as int) as l_linenumber", "id as l_partkey", "id as l_suppkey", "id + 0.5 as l_quantity",
                              "id * 2.5 as l_extendedprice").write.parquet(f"{tmp_dir}/lineitem.parquet")
    assert {r.l_orderkey: (r.has_usd, r.has_eur) for r in grep_currency_lineitem(spark, tmp_dir).collect()}[4] == (True, True)
    plan = grep_currency_lineitem(spark, tmp_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<.*?>") == 1


def test_a_long_run_of_digits_is_tried_once(spark):
    import time

    df = spark.range(1).select(F.repeat(F.lit("7"), 60_000).alias("t"))
    col = C.standardize_currency(C.standardize_units("t"))
    df.select(F.length(col)).collect()
    begun = time.time()
    assert df.select(F.length(col).alias("n")).first().n == 60_000
    assert time.time() - begun < 3  # from every digit on it takes far longer


def test_native_encoding_repair_is_for_texts_that_need_it(spark):
    from textforge.functions import encoding as E

    marks = [*E.CURLY_SINGLE, *E.CURLY_DOUBLE, *(a for a, _ in E.LIGATURES), *E.FULLWIDTH_SRC, *map(chr, (*range(9), 11, *range(14, 32), 127, 0xFFF9, 0xFFFC))]
    df = spark.createDataFrame([(f"a{m}é",) for m in marks] + [("plain",), ("é ü\t\n",), ("",), (None,)], "t string")
    t = F.col("t")
    assert df.filter(t.rlike(E.NEEDS_NATIVE)).count() == len(marks)
    assert df.filter(~E.fix_encoding_native(t).eqNullSafe(E._fix_native(t))).collect() == []


def test_a_date_phrase_is_looked_at_once(spark):
    from textforge.functions.dates import OPENING, normalize_date

    df = spark.createDataFrame([("last friday, it is said",), ("  3 Days  ago ",), ("it was yesterday",), ("",), (None,)], "t string")
    out = df.select("t", normalize_date(F.reverse(F.reverse("t")), F.lit("2024-06-01").cast("date")).alias("d"))
    assert {r.t: r.d for r in out.collect()} == {"last friday, it is said": "2024-05-31", "  3 Days  ago ": "2024-05-29", "it was yesterday": None, "": None, None: None}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(OPENING) == 1 and plan.count("reverse(reverse(") == 1
