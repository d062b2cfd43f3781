"""Queries for JSONL ingestion, repair, validation, quarantine and run reports.

Lines are derived from ``documents``: line_number = doc_id + 1 and the case
``doc_id % 10`` picks one kind of damage. The SQL twins compute the expected
outcome of each case from the construction.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.plans import ingest as I
from textforge.plans.catalog import register, table
from textforge.session import materialize
from textforge.sources.jsonl import chunk_id

# Letters-only version of the whole text: safe to splice into hand-built JSON.
SNIPPET = "regexp_replace(text, '[^A-Za-z ]', '')"
ID = "concat('doc-', CAST(doc_id AS STRING))"
PUBDATE = ("CASE WHEN doc_id % 40 = 0 THEN '2024-13-45' "
           "ELSE concat('2024-01-', lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0')) END")
RAW_URL = ("CASE doc_id % 3 WHEN 0 THEN concat('example.com/', CAST(doc_id AS STRING)) "
           "WHEN 1 THEN concat('httpss://news.example.com/', CAST(doc_id AS STRING)) ELSE 'not a url' END")
SPARK_LINE = f"""CASE doc_id % 10
  WHEN 0 THEN to_json(named_struct('document_id', {ID}, 'text', text, 'title', source,
       'categories', array(lang, source), 'publication_date', {PUBDATE}, 'source_url', {RAW_URL},
       'word_count', CASE WHEN doc_id % 50 = 20 THEN parse_json('10.5') WHEN doc_id % 50 = 30 THEN parse_json('"42"')
                          ELSE parse_json('null') END))
  WHEN 1 THEN concat('{{"document_id":"', {ID}, '","text":"She said "', {SNIPPET}, '" today"}}')
  WHEN 2 THEN CASE WHEN doc_id % 20 = 2 THEN '' ELSE '   ' END
  WHEN 3 THEN CASE doc_id % 30 WHEN 3 THEN 'null' WHEN 13 THEN '123' ELSE '[1]' END
  WHEN 4 THEN concat('{{"document_id":"', {ID}, '","title":"no text"}}')
  WHEN 5 THEN concat('{{"document_id":', CAST(doc_id AS STRING), ',"text":"', {SNIPPET}, '"}}')
  WHEN 6 THEN concat('{{"document_id":"', {ID}, '","text":"', {SNIPPET})
  WHEN 7 THEN concat('{{"document_id":"', {ID}, '","text":"', {SNIPPET}, '","title":"T"}} trailing')
  WHEN 8 THEN concat('{{"document_id":"', {ID}, '","text":"“', {SNIPPET}, '”​ done"}}')
  ELSE CASE WHEN doc_id % 30 = 9 THEN concat('garbage ', CAST(doc_id AS STRING), ' {{')
    WHEN doc_id % 30 = 19 THEN concat('{{"document_id":"', {ID}, '","text":"', {SNIPPET}, chr(1), ' end"}}')
    ELSE concat('{{"document_id":"', {ID}, '","text":"', {SNIPPET}, chr(2), ' says "so" now"}}') END
END"""


def lines_of(d, *keep):
    return d.select(*keep, (F.col("doc_id") + 1).alias("line_number"), F.expr(SPARK_LINE).alias("value"))


def derived_lines(spark, sf_dir):
    return lines_of(table(spark, sf_dir, "documents"))


def _classified(spark, sf_dir):
    return I.classify(derived_lines(spark, sf_dir))


# ---- expected outcome per case, in DuckDB SQL
DSNIP = "regexp_replace(text, '[^A-Za-z ]', '', 'g')"
DID = "concat('doc-', CAST(doc_id AS VARCHAR))"
EXPECTED = f"""
WITH b AS (SELECT doc_id, text, source, lang FROM documents),
e AS (SELECT doc_id + 1 AS line_number,
  CASE
    WHEN doc_id % 10 = 0 AND (doc_id % 40 = 0 OR doc_id % 50 = 20) THEN 'validation_error'
    WHEN doc_id % 10 IN (0, 1, 6, 7, 8) OR doc_id % 30 IN (19, 29) THEN 'valid'
    WHEN doc_id % 10 = 2 THEN 'empty'
    WHEN doc_id % 10 IN (3, 9) THEN 'json_error'
    WHEN doc_id % 10 IN (4, 5) THEN 'validation_error'
  END AS status,
  doc_id, text, source, lang FROM b)
SELECT line_number, status,
  CASE WHEN status = 'empty' THEN NULL
       WHEN status = 'json_error' THEN concat('line-', CAST(line_number AS VARCHAR))
       WHEN doc_id % 10 = 5 THEN CAST(doc_id AS VARCHAR)
       ELSE concat('doc-', CAST(doc_id AS VARCHAR)) END AS document_id,
  CASE status WHEN 'json_error' THEN 'JSONDecodeError' WHEN 'validation_error' THEN 'ValidationError' END AS error_type,
  CASE WHEN status = 'valid' THEN CASE doc_id % 10 WHEN 1 THEN 2 WHEN 6 THEN 5 WHEN 7 THEN 5 WHEN 9 THEN CASE doc_id % 30 WHEN 19 THEN 3 ELSE 4 END ELSE 1 END END
    AS repair_strategy,
  CASE WHEN status <> 'valid' THEN NULL
       WHEN doc_id % 10 = 0 THEN text
       WHEN doc_id % 10 = 1 THEN concat('She said "', {DSNIP}, '" today')
       WHEN doc_id % 10 = 6 THEN rtrim({DSNIP})
       WHEN doc_id % 30 = 19 THEN concat({DSNIP}, ' end')
       WHEN doc_id % 30 = 29 THEN concat({DSNIP}, ' says "so" now')
       WHEN doc_id % 10 = 7 THEN {DSNIP}
       WHEN doc_id % 10 = 8 THEN concat('“', {DSNIP}, '”​ done') END AS text,
  CASE WHEN status <> 'valid' THEN NULL WHEN doc_id % 10 = 0 THEN source WHEN doc_id % 10 = 7 THEN 'T' END AS title,
  CASE WHEN status = 'valid' AND doc_id % 10 = 0 THEN CASE doc_id % 3
       WHEN 0 THEN concat('https://example.com/', CAST(doc_id AS VARCHAR))
       WHEN 1 THEN concat('https://news.example.com/', CAST(doc_id AS VARCHAR)) END END AS source_url,
  CASE WHEN status = 'valid' AND doc_id % 10 = 0 THEN
       make_date(2024, 1, CAST(doc_id % 28 + 1 AS INTEGER)) END AS publication_date,
  CASE WHEN status = 'valid' AND doc_id % 50 = 30 THEN 42 END AS word_count,
  CASE WHEN status = 'valid' AND doc_id % 10 = 0 THEN 2 END AS n_categories
FROM e"""

INGEST_COLS = ("line_number", "status", "document_id", "error_type", "repair_strategy", "text", "title",
               "source_url", "publication_date", "word_count")


@register("ingest_documents_jsonl", sql=EXPECTED)
def ingest_documents_jsonl(spark, sf_dir):
    c = _classified(spark, sf_dir)
    ok = F.col("status") == "valid"
    fields = [F.when(ok, F.col(f)).alias(f) for f in INGEST_COLS[4:]]
    return c.select(*INGEST_COLS[:4], *fields, F.when(ok, F.size("categories")).alias("n_categories"))


@register(
    "run_summary_documents_jsonl",
    sql=f"""WITH x AS ({EXPECTED})
SELECT count(*) AS total_lines, count_if(status = 'empty') AS empty_lines,
  count_if(status = 'valid') AS processed_successfully, count_if(status = 'json_error') AS json_decode_errors,
  count_if(status = 'validation_error') AS validation_errors, CAST(0 AS BIGINT) AS processing_errors,
  count_if(status IN ('json_error', 'validation_error')) AS total_errors,
  concat(CAST(round_even(count_if(status = 'valid') / greatest(1, count(*) - count_if(status = 'empty')) * 100, 1)
         AS DECIMAL(10, 1)), '%') AS success_rate
FROM x""",
)
def run_summary_documents_jsonl(spark, sf_dir):
    return I.run_summary(_classified(spark, sf_dir))


@register(
    "quarantine_documents_jsonl",
    sql=f"""WITH x AS ({EXPECTED})
SELECT line_number, document_id, error_type FROM x WHERE status IN ('json_error', 'validation_error')""",
)
def quarantine_documents_jsonl(spark, sf_dir):
    return I.quarantine(_classified(spark, sf_dir)).select("line_number", "document_id", "error_type")


@register(
    "first_errors_documents_jsonl",
    sql=f"""WITH x AS ({EXPECTED})
SELECT line_number, document_id, error_type FROM x WHERE status IN ('json_error', 'validation_error')
ORDER BY line_number LIMIT 10""",
)
def first_errors_documents_jsonl(spark, sf_dir):
    return I.first_errors(_classified(spark, sf_dir)).select("line_number", "document_id", "error_type")


@register(
    "error_counts_documents_jsonl",
    sql=f"""WITH x AS ({EXPECTED})
SELECT error_type, count(*) AS n_errors FROM x WHERE status IN ('json_error', 'validation_error') GROUP BY 1""",
)
def error_counts_documents_jsonl(spark, sf_dir):
    return I.error_counts(_classified(spark, sf_dir))


@register(
    "batch_chunks_documents_jsonl",
    sql=f"""WITH x AS ({EXPECTED})
SELECT CAST(floor((line_number - 1) / 500) AS BIGINT) AS batch_id, count(*) AS n_lines,
  count_if(status = 'valid') AS n_valid, count_if(status = 'empty') AS n_empty,
  count_if(status <> 'empty') BETWEEN 1 AND 1000 AS accepted
FROM x GROUP BY 1""",
)
def batch_chunks_documents_jsonl(spark, sf_dir):
    c = _classified(spark, sf_dir)
    g = c.groupBy(chunk_id(F.col("line_number"), 500).alias("batch_id")).agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("status") == "valid").alias("n_valid"),
        F.count_if(F.col("status") == "empty").alias("n_empty"),
        F.count_if(F.col("status") != "empty").alias("_n"),
    )
    return g.select("batch_id", "n_lines", "n_valid", "n_empty",
                    F.col("_n").between(1, 1000).alias("accepted"))


@register(
    "document_status_jsonl",
    sql=f"""WITH x AS ({EXPECTED}),
sub AS (SELECT concat('doc-', CAST(doc_id AS VARCHAR)) AS document_id FROM documents),
res AS (SELECT DISTINCT document_id FROM x WHERE status = 'valid'),
bad AS (SELECT document_id, min(error_type) AS error_type FROM x WHERE status IN ('json_error', 'validation_error')
        GROUP BY document_id)
SELECT coalesce(sub.document_id, res.document_id, bad.document_id) AS document_id,
  CASE WHEN res.document_id IS NOT NULL THEN 'success' WHEN bad.document_id IS NOT NULL THEN 'failure'
       ELSE 'pending' END AS status,
  CASE WHEN res.document_id IS NULL THEN bad.error_type END AS error_type
FROM sub FULL OUTER JOIN res ON sub.document_id = res.document_id
FULL OUTER JOIN bad ON coalesce(sub.document_id, res.document_id) = bad.document_id""",
)
def document_status_jsonl(spark, sf_dir):
    """Pending / success / failure per submitted id (full outer joins)."""
    # read by two branches: the few columns are written once
    c = materialize(_classified(spark, sf_dir).select("document_id", "status", "error_type"), "line-status")
    sub = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("document_id")).distinct()
    res = c.filter(F.col("status") == "valid").select(F.col("document_id").alias("r_id")).distinct()
    bad = (c.filter(F.col("status").isin("json_error", "validation_error"))
           .groupBy(F.col("document_id").alias("b_id")).agg(F.min("error_type").alias("error_type")))
    j = sub.join(res, sub.document_id == res.r_id, "full_outer")
    k = F.coalesce(F.col("document_id"), F.col("r_id"))
    j = j.select(k.alias("k"), "r_id").join(bad, F.col("k") == bad.b_id, "full_outer")
    return j.select(
        F.coalesce(F.col("k"), F.col("b_id")).alias("document_id"),
        F.when(F.col("r_id").isNotNull(), "success").when(F.col("b_id").isNotNull(), "failure").otherwise("pending")
        .alias("status"),
        F.when(F.col("r_id").isNull(), F.col("error_type")).alias("error_type"),
    )


@register(
    "incremental_unprocessed",
    sql="""SELECT d.doc_id, d.source FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id
ORDER BY d.doc_id LIMIT 1000""",
)
def incremental_unprocessed(spark, sf_dir):
    """Rows not yet processed (no label row), capped at 1,000 as the reference's pull."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    done = table(spark, sf_dir, "labels", spread_rows=False).select("doc_id")
    return d.join(done, "doc_id", "left_anti").orderBy("doc_id").limit(1000)


# ---- S10 / R3: validation without repair (strategies 2-5 off)
EXPECTED_NO_REPAIR = f"""WITH x AS ({EXPECTED}) SELECT line_number,
  CASE WHEN (line_number - 1) % 10 IN (1, 6, 7, 9) THEN 'json_error' ELSE status END AS status FROM x"""


@register("validate_only_documents_jsonl", sql=EXPECTED_NO_REPAIR)
def validate_only_documents_jsonl(spark, sf_dir):
    c = I.classify(derived_lines(spark, sf_dir), repair=False)
    return c.select("line_number", "status")


@register(
    "validate_only_summary_jsonl",
    sql=f"""WITH x AS ({EXPECTED_NO_REPAIR})
SELECT count_if(status <> 'empty') AS non_blank_lines, count_if(status = 'valid') AS valid_records,
  count_if(status = 'json_error') AS invalid_json, count_if(status = 'validation_error') AS invalid_schema FROM x""",
)
def validate_only_summary_jsonl(spark, sf_dir):
    """R3 + R4: validation totals and the non-blank line count."""
    c = I.classify(derived_lines(spark, sf_dir), repair=False)
    s = F.col("status")
    return c.agg(F.count_if(s != "empty").alias("non_blank_lines"), F.count_if(s == "valid").alias("valid_records"),
                 F.count_if(s == "json_error").alias("invalid_json"),
                 F.count_if(s == "validation_error").alias("invalid_schema"))
