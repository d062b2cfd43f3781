"""Golden vectors for the cleaning chain (native steps; encoding and typos off)."""

import pytest
from pyspark.sql import functions as F

from textforge.config import CleaningConfig
from textforge.functions import clean as C

NATIVE = CleaningConfig(fix_encoding=False, enable_typo_correction=False)

GOLDEN = [
    ("$10.50 and $1,000 and €50 and 50€ and £20", "USD 10. 50 and USD 1, 000 and 50 and 50 EUR and GBP 20"),
    ("a.b,c?d!e ...!!! ??? ,, --", "a. b, c? d! e .! ? , -"),
    ("“Hello,” he said—‘it’s great’.", "\"Hello,\" he said-'it's great'."),
    ("US Dollars euroś usd. Pounds sterling poundsterling", "USD euro USD. Pounds sterling GBP"),
    ("5mé 5m", "5m 5 meters"),
    ("١٢ m", "meters"),
    ("a < b and c > d", "a d"),
    ("visit example.com/a?b=c", "visit example. com/a? b=c"),
    ("<p>Hello &amp; <b\n>w</b>. It's 5cm and costs $5.</p>", "Hello &amp; w . It's 5 centimeters and costs USD 5."),
    ("5M €500M", "5M 500M"),
    ("1m", "1 meters"),
    ("2.5kg", "2. 5 kilograms"),
    ("The company's revenue was €500M last quarter.", "The company's revenue was 500M last quarter."),
    ("The price is $100 and it weighs 5kg in New York.", "The price is USD 100 and it weighs 5 kilograms in New York."),
    ("  many \t\n spaces\x1c here ", "many spaces here"),
    ("", ""),
]


def test_golden_chain(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(GOLDEN)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", C.clean_text("t", NATIVE).alias("c")).collect()}
    for i, (_, want) in enumerate(GOLDEN):
        assert got[i] == want, (GOLDEN[i][0], got[i], want)


def test_currency_units_before_spacing(spark):
    text = "The price is $10.50. It's 5m long and weighs 2kg. Also £20 and 3km."
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(C.standardize_units(C.standardize_currency("t")).alias("c")).first().c
    for piece in ("USD 10.50", "5 meters", "2 kilograms", "GBP 20", "3 kilometers"):
        assert piece in r
    assert "$" not in r


def test_disabled_steps_add_no_expression(spark):
    off = CleaningConfig(**{k: False for k in (
        "remove_html_tags", "normalize_whitespace", "fix_encoding", "normalize_punctuation",
        "remove_excessive_punctuation", "add_space_after_punctuation", "standardize_units", "standardize_currency",
        "enable_typo_correction")})
    df = spark.createDataFrame([("<b>x</b>  $5",)], "t string")
    e = df.select(C.clean_text("t", off).alias("c"))
    assert e.first().c == "<b>x</b>  $5"
    assert "regexp_replace" not in e._jdf.queryExecution().optimizedPlan().toString()


def test_override_merge():
    base = CleaningConfig.settings_default()
    m = base.merge({"typo_min_length": 4, "typo_correction": {"confidence_threshold": 0.9}, "fix_encoding": None})
    assert m.typo_min_length == 4 and m.typo_confidence == 0.9 and m.fix_encoding is True
    assert base.typo_min_length == 2


def test_custom_step(spark):
    cfg = NATIVE.merge({"extra_steps": ["remove_emoji"], "normalize_punctuation": False})
    df = spark.createDataFrame([("hi 😀 there",)], "t string")
    assert df.select(C.clean_text("t", cfg).alias("c")).first().c == "hi there"


def test_fix_encoding(spark):
    from textforge.functions.encoding import fix_text_python

    assert fix_text_python("cafÃ© &amp; ﬁne") == "café & fine"
    df = spark.createDataFrame([("cafÃ© &amp; bar",), ("plain “text”",), ("ＡＢＣ",)], "t string")
    cfg = CleaningConfig(enable_typo_correction=False, normalize_punctuation=False)
    got = [r.c for r in df.select(C.clean_text("t", cfg).alias("c")).collect()]
    assert got == ["café & bar", 'plain "text"', "ABC"]


@pytest.mark.parametrize("text", ["a..b", "x!!!y", "--", "?,?,"])
def test_excess_punctuation_single_pass_equals_five_rules(spark, text):
    import re

    want = text
    for pat, rep in ((r"\.{2,}", "."), (r",{2,}", ","), (r"!{2,}", "!"), (r"\?{2,}", "?"), (r"-{2,}", "-")):
        want = re.sub(pat, rep, want)
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(C.remove_excessive_punctuation("t").alias("c")).first().c == want
