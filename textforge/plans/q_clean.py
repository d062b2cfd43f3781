"""Queries for the cleaning operators (C1-C13) and document metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge import oracle as O
from textforge.config import CleaningConfig
from textforge.functions import clean as C
from textforge.functions.metrics import reading_time, word_count
from textforge.plans.catalog import register, table
from textforge.sources.jsonl import once

# Native chain: every step except encoding repair (Python) and typos (a join).
NATIVE = CleaningConfig(fix_encoding=False, enable_typo_correction=False)

# Sentences with currency, units, dashes, quotes and punctuation runs, built
# from lineitem columns. Plain SQL valid in Spark and DuckDB alike.
LINEITEM_SENTENCE = """CASE l_linenumber % 4
  WHEN 0 THEN concat('Paid $', CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING), '.',
       lpad(CAST(l_linenumber AS STRING), 2, '0'), ' for ', CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING),
       'kg of parts—about ', CAST(l_partkey % 90 AS STRING), ' lbs!!! Total: £',
       CAST(l_suppkey AS STRING), ' or ', CAST(l_orderkey % 1000 AS STRING), '€...')
  WHEN 1 THEN concat('“Shipped” ', CAST(l_orderkey % 500 AS STRING), 'km and ',
       CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING), ' m,then ', CAST(l_partkey % 70 AS STRING),
       'cm ‘fast’ at ', CAST(l_suppkey % 100 AS STRING), '% off,, paid in US dollars ?? or euros')
  WHEN 2 THEN concat('<p>Order ', CAST(l_orderkey AS STRING), '</p><b>weighs</b> ',
       CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING), 'g   and   ', CAST(l_partkey % 40 AS STRING),
       'ft–', CAST(l_linenumber AS STRING), 'mi;  cost usd ', CAST(l_suppkey AS STRING),
       '.5 or GBP', CAST(l_partkey % 9 AS STRING), ' pounds sterling--poundsterling')
  ELSE concat('Line ', CAST(l_linenumber AS STRING), '.Qty ', CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING),
       ' units−', CAST(l_partkey % 100 AS STRING), '.', CAST(l_suppkey % 10 AS STRING),
       '% tax!! $ ', CAST(l_orderkey % 300 AS STRING), ',', CAST(l_partkey % 1000 AS STRING), ' EUR ',
       CAST(l_suppkey % 50 AS STRING), ' € Eur.')
END"""

LI_KEYS = "l_orderkey, l_linenumber"


def _lineitem_sentences(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.expr(LINEITEM_SENTENCE).alias("sentence"))


# ---------------------------------------------------------------- flagship
@register(
    "clean_lang_summary",
    sql=f"""
WITH c AS (SELECT lang, {O.sql_clean('text', NATIVE)} AS cleaned FROM documents),
w AS (SELECT lang, {O.sql_word_count('cleaned')} AS wc FROM c),
r AS (SELECT lang, wc, {O.sql_reading_time('wc')} AS rt FROM w)
SELECT lang, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(wc) AS BIGINT) AS total_words,
       CAST(sum(rt) AS BIGINT) AS total_reading_minutes
FROM r GROUP BY lang""",
)
def clean_lang_summary(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    c = docs.select("lang", C.clean_text("text", NATIVE).alias("cleaned"))
    w = c.select("lang", word_count(F.col("cleaned")).alias("wc"))
    r = w.select("lang", "wc", reading_time(F.col("wc")).alias("rt"))
    return r.groupBy("lang").agg(
        F.count("*").alias("n_docs"),
        F.sum("wc").cast("bigint").alias("total_words"),
        F.sum("rt").cast("bigint").alias("total_reading_minutes"),
    )


# ---------------------------------------------------------------- full chain per table
@register(
    "clean_documents",
    sql=f"""
WITH c AS (SELECT doc_id, {O.sql_clean('text', NATIVE)} AS cleaned_text FROM documents),
w AS (SELECT doc_id, cleaned_text, {O.sql_word_count('cleaned_text')} AS word_count FROM c)
SELECT doc_id, cleaned_text, word_count, {O.sql_reading_time('word_count')} AS reading_time FROM w""",
)
def clean_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    c = d.select("doc_id", C.clean_text("text", NATIVE).alias("cleaned_text"))
    w = c.withColumn("word_count", word_count(F.col("cleaned_text")))
    return w.withColumn("reading_time", reading_time(F.col("word_count")))


@register("clean_pages_html", sql=f"SELECT page_id, {O.sql_clean('html', NATIVE)} AS cleaned_html FROM pages")
def clean_pages_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.clean_text("html", NATIVE).alias("cleaned_html"))


@register(
    "clean_conversations",
    sql=f"SELECT conv_id, turn, role, {O.sql_clean('text', NATIVE)} AS cleaned_text FROM conversations",
)
def clean_conversations(spark, sf_dir):
    cv = table(spark, sf_dir, "conversations")
    return cv.select("conv_id", "turn", "role", C.clean_text("text", NATIVE).alias("cleaned_text"))


@register(
    "clean_lineitem_sentences",
    sql=f"""WITH s AS (SELECT {LI_KEYS}, {LINEITEM_SENTENCE} AS sentence FROM lineitem)
SELECT {LI_KEYS}, {O.sql_clean('sentence', NATIVE)} AS cleaned FROM s""",
)
def clean_lineitem_sentences(spark, sf_dir):
    s = _lineitem_sentences(spark, sf_dir)
    return s.select("l_orderkey", "l_linenumber", C.clean_text("sentence", NATIVE).alias("cleaned"))


# ---------------------------------------------------------------- single steps
@register("html_tags_pages", sql=f"SELECT page_id, {O.sql_html('html')} AS no_tags FROM pages")
def html_tags_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.remove_html_tags("html").alias("no_tags"))


@register("whitespace_documents", sql=f"SELECT doc_id, {O.sql_ws('text')} AS normalized FROM documents")
def whitespace_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", C.normalize_whitespace("text").alias("normalized"))


@register(
    "punctuation_normalize_lineitem",
    sql=f"""WITH s AS (SELECT {LI_KEYS}, {LINEITEM_SENTENCE} AS sentence FROM lineitem)
SELECT {LI_KEYS}, {O.sql_punct('sentence')} AS normalized FROM s""",
)
def punctuation_normalize_lineitem(spark, sf_dir):
    s = _lineitem_sentences(spark, sf_dir)
    out = C.remove_non_printable(C.normalize_smart_quotes(C.normalize_unicode_dashes("sentence")))
    return s.select("l_orderkey", "l_linenumber", out.alias("normalized"))


@register("non_printable_documents", sql=f"SELECT doc_id, {O.sql_punct('text', False, False)} AS printable FROM documents")
def non_printable_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", C.remove_non_printable("text").alias("printable"))


@register("excess_punctuation_documents", sql=f"SELECT doc_id, {O.sql_excess('text')} AS collapsed FROM documents")
def excess_punctuation_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", C.remove_excessive_punctuation("text").alias("collapsed"))


@register("space_after_punctuation_documents", sql=f"SELECT doc_id, {O.sql_space_after('text')} AS spaced FROM documents")
def space_after_punctuation_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", C.add_space_after_punctuation("text").alias("spaced"))


@register(
    "currency_lineitem",
    sql=f"""WITH s AS (SELECT {LI_KEYS}, {LINEITEM_SENTENCE} AS sentence FROM lineitem)
SELECT {LI_KEYS}, {O.sql_currency('sentence')} AS standardized FROM s""",
)
def currency_lineitem(spark, sf_dir):
    s = _lineitem_sentences(spark, sf_dir)
    return s.select("l_orderkey", "l_linenumber", C.standardize_currency("sentence").alias("standardized"))


@register(
    "units_lineitem",
    sql=f"""WITH s AS (SELECT {LI_KEYS}, {LINEITEM_SENTENCE} AS sentence FROM lineitem)
SELECT {LI_KEYS}, {O.sql_units('sentence')} AS standardized FROM s""",
)
def units_lineitem(spark, sf_dir):
    s = _lineitem_sentences(spark, sf_dir)
    return s.select("l_orderkey", "l_linenumber", C.standardize_units("sentence").alias("standardized"))


# A per-call override merged over the settings: no HTML stripping, no
# punctuation group, no currency.
OVERRIDE = NATIVE.merge({"remove_html_tags": False, "normalize_punctuation": False, "standardize_currency": False})


@register(
    "config_override_lineitem",
    sql=f"""WITH s AS (SELECT {LI_KEYS}, {LINEITEM_SENTENCE} AS sentence FROM lineitem)
SELECT {LI_KEYS}, {O.sql_clean('sentence', OVERRIDE)} AS cleaned FROM s""",
)
def config_override_lineitem(spark, sf_dir):
    s = _lineitem_sentences(spark, sf_dir)
    return s.select("l_orderkey", "l_linenumber", C.clean_text("sentence", OVERRIDE).alias("cleaned"))


@register(
    "grep_currency_lineitem",
    sql=f"""WITH s AS (SELECT {LI_KEYS}, {LINEITEM_SENTENCE} AS sentence FROM lineitem),
c AS (SELECT {LI_KEYS}, {O.sql_clean('sentence', NATIVE)} AS cleaned FROM s)
SELECT {LI_KEYS}, regexp_matches(cleaned, 'USD') AS has_usd, regexp_matches(cleaned, 'EUR') AS has_eur
FROM c WHERE regexp_matches(cleaned, 'USD|EUR')""",
)
def grep_currency_lineitem(spark, sf_dir):
    """Records whose cleaned text mentions USD or EUR."""
    # once: the filter would else be pushed below and clean every sentence again
    c = clean_lineitem_sentences(spark, sf_dir).withColumn("cleaned", once(F.col("cleaned")))
    return c.filter(F.col("cleaned").rlike("USD|EUR")).select(
        "l_orderkey", "l_linenumber", F.col("cleaned").contains("USD").alias("has_usd"),
        F.col("cleaned").contains("EUR").alias("has_eur"))
