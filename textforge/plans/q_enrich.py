"""Queries for URL repair (S8) and date normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.functions.dates import WEEKDAYS, normalize_date
from textforge.functions.patterns import WS
from textforge.functions.urls import is_http_url, sanitize_url
from textforge.oracle import lit
from textforge.plans.catalog import register, table

# URL damage derived from pages.url (same SQL in both engines).
URL_DAMAGE = """CASE page_id % 7
  WHEN 0 THEN replace(url, 'https://', 'httpss://')
  WHEN 1 THEN replace(replace(url, 'http://', 'http.://'), 'https://', 'https.://')
  WHEN 2 THEN substr(url, instr(url, '://') + 3)
  WHEN 3 THEN concat('  ', url, ' ')
  WHEN 4 THEN concat('//', substr(url, instr(url, '://') + 3))
  WHEN 5 THEN replace(url, 'http://', 'httpps://')
  ELSE replace(substr(url, instr(url, '://') + 3), '.', '_')
END"""


def _sql_strip(e: str) -> str:
    return f"regexp_replace({e}, {lit(f'^{WS}+|{WS}+$')}, '', 'g')"


def _sql_sanitize(e: str) -> str:
    u = _sql_strip(e)
    for bad, good in (("https.://", "https://"), ("http.://", "http://"), ("httpss://", "https://"),
                      ("httpps://", "https://")):
        u = f"replace({u}, '{bad}', '{good}')"
    return (f"CASE WHEN {e} IS NULL OR {e} = '' THEN NULL "
            f"WHEN starts_with({u}, 'http://') OR starts_with({u}, 'https://') THEN {u} "
            f"WHEN contains({u}, '.') AND NOT starts_with({u}, '//') THEN concat('https://', {u}) END")


@register(
    "url_sanitize_pages",
    sql=f"""WITH d AS (SELECT page_id, {URL_DAMAGE} AS raw_url FROM pages),
s AS (SELECT page_id, raw_url, {_sql_sanitize('raw_url')} AS sanitized_url FROM d)
SELECT page_id, raw_url, sanitized_url,
  coalesce(regexp_full_match(sanitized_url, '{r"https?://[A-Za-z0-9]([A-Za-z0-9.\-]*[A-Za-z0-9])?(:[0-9]{1,5})?([/?#][^\s]*)?"}'), false) AS valid
FROM s""",
)
def url_sanitize_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.expr(URL_DAMAGE).alias("raw_url"))
    s = p.withColumn("sanitized_url", sanitize_url(F.col("raw_url")))
    return s.withColumn("valid", F.coalesce(is_http_url(F.col("sanitized_url")), F.lit(False)))


# ---------------------------------------------------------------- dates
def _spark_phrases(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    d = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey") % 12
    ck = F.col("o_custkey")
    phrase = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(d, "MMMM d, yyyy"))
        .when(k == 2, F.upper(F.date_format(d, "d MMMM yyyy")))
        .when(k == 3, F.date_format(d, "MMM d, yyyy"))
        .when(k == 4, F.date_format(d, "M/d/yyyy"))
        .when(k == 5, F.concat((ck % 40).cast("string"), F.lit(" days ago")))
        .when(k == 6, F.when(ck % 2 == 0, F.lit("yesterday")).otherwise(F.lit("  Today ")))
        .when(k == 7, F.concat(F.lit("last "), F.date_format(F.date_add(d, (ck % 5).cast("int")), "EEEE")))
        .when(k == 8, F.concat((ck % 6 + 1).cast("string"), F.lit(" months ago")))
        .when(k == 9, F.concat(F.lit("Last "), F.element_at(F.array(F.lit("week"), F.lit("month"), F.lit("year")),
                                                            (ck % 3 + 1).cast("int"))))
        .when(k == 10, F.concat((ck % 3 + 1).cast("string"), F.lit(" weeks ago")))
        .otherwise(F.when(ck % 2 == 0, F.date_format(d, "MMMM yyyy")).otherwise(F.col("o_orderpriority")))
    )
    ref = F.date_add(d, (ck % 9).cast("int"))
    return o.select("o_orderkey", phrase.alias("phrase"), ref.alias("ref_date"))


def _sql_weekday_idx(e: str) -> str:
    names = ", ".join(f"'{w}'" for w in WEEKDAYS)
    return f"(list_position([{names}], {e}) - 1)"


def _sql_normalize_date(text: str, ref: str) -> str:
    s = f"lower(regexp_replace({_sql_strip(text)}, {lit(WS + '+')}, ' ', 'g'))"
    wd = f"lower(regexp_extract({text}, {lit(f'(?i)^last{WS}+([a-zA-Z]+)')}, 1))"
    idx = _sql_weekday_idx(wd)
    n = f"TRY_CAST(regexp_extract({s}, '^(\\d{{1,4}}) ', 1) AS INTEGER)"
    unit = f"regexp_extract({s}, '^\\d{{1,4}} (day|week|month|year)s? ago$', 1)"
    in_unit = f"regexp_extract({s}, '^in (\\d{{1,4}}) (day|week)s?$', 2)"
    in_n = f"TRY_CAST(regexp_extract({s}, '^in (\\d{{1,4}}) ', 1) AS INTEGER)"
    last_unit = f"regexp_extract({s}, '^last (week|month|year)$', 1)"
    days_ago = f"(((isodow({ref}) - 1) - {idx} + 7) % 7)"

    def dt(fmt: str) -> str:
        return f"CAST(try_strptime({s}, '{fmt}') AS DATE)"

    return f"""strftime(CASE
  WHEN {ref} IS NOT NULL AND {idx} IS NOT NULL THEN {ref} - CAST(CASE WHEN {days_ago} = 0 THEN 7 ELSE {days_ago} END AS INTEGER)
  WHEN regexp_full_match({s}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN {dt('%Y-%m-%d')}
  WHEN regexp_full_match({s}, '[a-z]+ \\d{{1,2}}, \\d{{4}}') THEN coalesce({dt('%B %d, %Y')}, {dt('%b %d, %Y')})
  WHEN regexp_full_match({s}, '\\d{{1,2}} [a-z]+ \\d{{4}}') THEN coalesce({dt('%d %B %Y')}, {dt('%d %b %Y')})
  WHEN regexp_full_match({s}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN {dt('%m/%d/%Y')}
  WHEN {s} = 'today' THEN {ref}
  WHEN {s} = 'yesterday' THEN {ref} - 1
  WHEN {s} = 'tomorrow' THEN {ref} + 1
  WHEN {unit} = 'day' THEN {ref} - {n}
  WHEN {unit} = 'week' THEN {ref} - {n} * 7
  WHEN {unit} = 'month' THEN CAST({ref} - to_months({n}) AS DATE)
  WHEN {unit} = 'year' THEN CAST({ref} - to_months({n} * 12) AS DATE)
  WHEN {in_unit} = 'day' THEN {ref} + {in_n}
  WHEN {in_unit} = 'week' THEN {ref} + {in_n} * 7
  WHEN {last_unit} = 'week' THEN {ref} - 7
  WHEN {last_unit} = 'month' THEN CAST({ref} - to_months(1) AS DATE)
  WHEN {last_unit} = 'year' THEN CAST({ref} - to_months(12) AS DATE)
END, '%Y-%m-%d')"""


_SQL_PHRASES = """SELECT o_orderkey,
  CASE o_orderkey % 12
    WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
    WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%B %-d, %Y')
    WHEN 2 THEN upper(strftime(CAST(o_orderdate AS DATE), '%-d %B %Y'))
    WHEN 3 THEN strftime(CAST(o_orderdate AS DATE), '%b %-d, %Y')
    WHEN 4 THEN strftime(CAST(o_orderdate AS DATE), '%-m/%-d/%Y')
    WHEN 5 THEN concat(CAST(o_custkey % 40 AS VARCHAR), ' days ago')
    WHEN 6 THEN CASE WHEN o_custkey % 2 = 0 THEN 'yesterday' ELSE '  Today ' END
    WHEN 7 THEN concat('last ', strftime(CAST(o_orderdate AS DATE) + CAST(o_custkey % 5 AS INTEGER), '%A'))
    WHEN 8 THEN concat(CAST(o_custkey % 6 + 1 AS VARCHAR), ' months ago')
    WHEN 9 THEN concat('Last ', (['week', 'month', 'year'])[CAST(o_custkey % 3 + 1 AS INTEGER)])
    WHEN 10 THEN concat(CAST(o_custkey % 3 + 1 AS VARCHAR), ' weeks ago')
    ELSE CASE WHEN o_custkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%B %Y') ELSE o_orderpriority END
  END AS phrase,
  CAST(o_orderdate AS DATE) + CAST(o_custkey % 9 AS INTEGER) AS ref_date
FROM orders"""


@register(
    "date_normalize_orders",
    sql=f"""WITH p AS ({_SQL_PHRASES})
SELECT o_orderkey, phrase, ref_date, {_sql_normalize_date('phrase', 'ref_date')} AS temporal_metadata FROM p""",
)
def date_normalize_orders(spark, sf_dir):
    p = _spark_phrases(spark, sf_dir)
    return p.withColumn("temporal_metadata", normalize_date(F.col("phrase"), F.col("ref_date")))


@register(
    "last_weekday_events",
    sql=f"""WITH p AS (SELECT event_id, CAST(ts AS DATE) AS ref_date,
  concat('last ', (['monday','tuesday','wednesday','thursday','friday','saturday','sunday'])[CAST(user_id % 7 + 1 AS INTEGER)], ' at noon') AS phrase
  FROM events)
SELECT event_id, ref_date, phrase, {_sql_normalize_date('phrase', 'ref_date')} AS last_date FROM p""",
)
def last_weekday_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    names = F.array(*[F.lit(w) for w in WEEKDAYS])
    p = e.select(
        "event_id",
        F.col("ts").cast("date").alias("ref_date"),
        F.concat(F.lit("last "), F.element_at(names, (F.col("user_id") % 7 + 1).cast("int")), F.lit(" at noon")).alias("phrase"),
    )
    return p.withColumn("last_date", normalize_date(F.col("phrase"), F.col("ref_date")))
