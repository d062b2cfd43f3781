"""Queries for language identification (E8): profiles from the labelled documents, every document scored."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge import oracle as O
from textforge.functions import clean as C
from textforge.operators.language import LEADS, TOP_K, calibrate, detect_language, train_profiles
from textforge.plans.catalog import register, table
from textforge.session import materialize
from textforge.plans.q_clean import NATIVE


def _cleaned(spark, sf_dir):
    # Used by the training, scoring and join-back branches: written once.
    d = table(spark, sf_dir, "documents")
    return materialize(d.select("doc_id", "lang", C.clean_text("text", NATIVE).alias("cleaned")), "lang-cleaned")


def _sql_grams(src: str, key: str) -> str:
    t = "regexp_replace(lower(cleaned), '[^\\p{L}]+', ' ', 'g')"
    return f"""SELECT {key}, substr(t, i, 3) AS gram FROM (
  SELECT {key}, t, unnest(generate_series(1, length(t) - 2)) AS i FROM (SELECT {key}, {t} AS t FROM {src}) WHERE length(t) >= 3)"""


SQL_LANG = f"""
WITH c AS (SELECT doc_id, lang, {O.sql_clean('text', NATIVE)} AS cleaned FROM documents),
tr AS (SELECT * FROM c),
te AS (SELECT * FROM c),
lg AS ({_sql_grams('tr', 'lang')}),
lc AS (SELECT lang, gram, count(*) AS cnt FROM lg GROUP BY ALL),
prof AS (SELECT lang, gram, rank FROM (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, gram) AS rank
         FROM lc) WHERE rank <= {TOP_K}),
dg AS ({_sql_grams('te', 'doc_id')}),
dc AS (SELECT doc_id, gram, count(*) AS cnt FROM dg GROUP BY ALL),
dp AS (SELECT doc_id, gram, rank FROM (SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, gram) AS rank
       FROM dc) WHERE rank <= {TOP_K}),
nd AS (SELECT doc_id, count(*) AS n FROM dp GROUP BY ALL),
pl AS (SELECT dp.doc_id, prof.lang, sum({TOP_K} - abs(dp.rank - prof.rank)) AS gain FROM dp JOIN prof USING (gram) GROUP BY ALL),
best AS (SELECT pl.doc_id, arg_min(pl.lang, (nd.n * {TOP_K} - pl.gain) * 1000 + CASE pl.lang WHEN 'de' THEN 0 WHEN 'en' THEN 1
           WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END) AS detected
         FROM pl JOIN nd USING (doc_id) GROUP BY pl.doc_id)
SELECT te.doc_id, te.lang, CASE WHEN length(trim(te.cleaned)) < 10 THEN NULL ELSE best.detected END AS detected
FROM te LEFT JOIN best USING (doc_id)"""


def _detected(spark, sf_dir):
    c = _cleaned(spark, sf_dir)
    profiles = train_profiles(c, "cleaned", "lang")
    return detect_language(c, "cleaned", profiles, out_col="detected").select("doc_id", "lang", "detected")


@register("language_detect_documents", sql=SQL_LANG)
def language_detect_documents(spark, sf_dir):
    return _detected(spark, sf_dir)


@register(
    "language_accuracy_documents",
    sql=f"""WITH x AS ({SQL_LANG}) SELECT lang, count(*) AS n_docs, count_if(detected = lang) AS n_correct,
  count_if(detected IS NULL) AS n_undetected FROM x GROUP BY lang""",
)
def language_accuracy_documents(spark, sf_dir):
    """In-sample: the profiles come from the rows that are scored."""
    x = _detected(spark, sf_dir)
    return x.groupBy("lang").agg(F.count("*").alias("n_docs"), F.count_if(F.col("detected") == F.col("lang")).alias("n_correct"),
                                 F.count_if(F.col("detected").isNull()).alias("n_undetected"))


# ---- held-out rows: profiles from three fifths of the documents, confidences from another, answers for the last
LEAST_CONFIDENCE = 0.9  # fixed value: the shipped threshold
SQL_HELD_OUT = SQL_LANG[: SQL_LANG.rindex("SELECT te.doc_id")].replace("tr AS (SELECT * FROM c)", "tr AS (SELECT * FROM c WHERE doc_id % 5 < 3)").replace(
    "te AS (SELECT * FROM c)", "te AS (SELECT * FROM c WHERE doc_id % 5 >= 3)").rstrip() + f""",
gains AS (SELECT doc_id, list(gain ORDER BY gain DESC) AS g FROM pl GROUP BY 1),
found AS (SELECT te.doc_id, te.lang, CASE WHEN length(trim(te.cleaned)) < 10 THEN NULL ELSE best.detected END AS detected,
  CASE WHEN length(trim(te.cleaned)) < 10 THEN NULL ELSE CAST({LEADS} * (g[1] - coalesce(g[2], 0)) // ({TOP_K} * nd.n) AS INTEGER) END AS lead
  FROM te LEFT JOIN best USING (doc_id) LEFT JOIN gains USING (doc_id) LEFT JOIN nd USING (doc_id)),
step AS (SELECT lead, count_if(detected = lang) AS r, count(*) AS n FROM found WHERE doc_id % 5 = 3 AND lead IS NOT NULL AND lang IS NOT NULL GROUP BY 1),
span AS (SELECT x.lead AS a, y.lead AS b, sum(z.r) / sum(z.n) AS m FROM step x JOIN step y ON x.lead <= y.lead JOIN step z ON z.lead BETWEEN x.lead AND y.lead GROUP BY 1, 2),
iso AS (SELECT lead, max(m) AS confidence FROM (SELECT step.lead, a, min(m) AS m FROM step JOIN span ON a <= step.lead AND b >= step.lead GROUP BY 1, 2) GROUP BY 1),
answer AS (SELECT found.doc_id, lang, detected, round(CASE WHEN found.lead IS NOT NULL THEN coalesce((SELECT max(confidence) FROM iso WHERE iso.lead <= found.lead), 0) END, 9) AS confidence
  FROM found WHERE doc_id % 5 = 4)"""


def _held_out(spark, sf_dir):
    c = _cleaned(spark, sf_dir)
    profiles = materialize(train_profiles(c.filter("doc_id % 5 < 3"), "cleaned", "lang"), "lang-profiles")
    scored = detect_language(c.filter("doc_id % 5 = 3"), "cleaned", profiles, out_col="detected", lead_col="lead")
    steps = calibrate(scored, "lang", "detected", "lead")
    return detect_language(c.filter("doc_id % 5 = 4"), "cleaned", profiles, out_col="detected", calibration=steps, least_confidence=0.0)


@register("language_confidence_documents", sql=SQL_HELD_OUT + " SELECT doc_id, lang, detected, confidence FROM answer")
def language_confidence_documents(spark, sf_dir):
    return _held_out(spark, sf_dir).select("doc_id", "lang", "detected", F.round("confidence", 9).alias("confidence"))


@register(
    "language_held_out_accuracy",
    sql=SQL_HELD_OUT + f""" SELECT lang, count(*) AS n_docs, count_if(detected = lang) AS n_correct, count_if(confidence >= {LEAST_CONFIDENCE}) AS n_sure,
  count_if(confidence >= {LEAST_CONFIDENCE} AND detected = lang) AS n_sure_correct FROM answer GROUP BY lang""",
)
def language_held_out_accuracy(spark, sf_dir):
    x = _held_out(spark, sf_dir)
    right, sure = F.col("detected") == F.col("lang"), F.round("confidence", 9) >= LEAST_CONFIDENCE
    return x.groupBy("lang").agg(F.count("*").alias("n_docs"), F.count_if(right).alias("n_correct"), F.count_if(sure).alias("n_sure"), F.count_if(sure & right).alias("n_sure_correct"))
