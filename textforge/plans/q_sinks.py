"""Queries that write with the sinks (K1-K8) under the shared folder and read the result back, and file ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge import oracle as O
from textforge.config import CleaningConfig, PipelineConfig
from textforge.plans import ingest as I
from textforge.plans.catalog import register, table
from textforge.plans.preprocess import preprocess
from textforge.plans.q_ingest import EXPECTED, derived_lines, lines_of
from textforge.session import materialize, scratch_path
from textforge.sinks import writers as K

RUN_DATE = "2024-06-01"
# Steps with a SQL twin; the metadata follow the settings.
CFG = PipelineConfig(cleaning=CleaningConfig(fix_encoding=False, enable_typo_correction=False), entity_recognition=False)

# One article for each document; the same expressions run in both engines.
ID = "concat('doc-', CAST(doc_id AS STRING))"
TEXT = "CASE WHEN doc_id % 11 = 0 THEN 'last friday' ELSE text END"
TITLE = "concat(upper(source), ' report  ')"
DAYS = "CAST(doc_id % 365 AS INT)"


def articles(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    null = lambda t: F.lit(None).cast(t)
    every = lambda n, c: F.when(F.col("doc_id") % n == 0, c)
    meta = F.struct(F.col("source").alias("feed"), F.lit("  wire  ").alias("desk"), F.lit("").alias("empty"),
                    every(5, F.lit(9)).alias("reading_time"), every(3, F.lit(" xx ")).alias("language"),
                    F.array(F.lit(" a "), F.lit(""), F.col("lang")).alias("list"))
    return d.select(
        "doc_id", F.expr(ID).alias("document_id"), F.expr(TEXT).alias("text"), F.expr(TITLE).alias("title"),
        F.lit(" <i></i> ").alias("excerpt"), F.concat(F.lit("  by "), "lang").alias("author"),
        F.when(F.col("doc_id") % 22 != 0, F.date_add(F.lit("2024-01-01").cast("date"), F.expr(DAYS))).alias("publication_date"),
        null("date").alias("revision_date"), F.concat(F.lit("https://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string")).alias("source_url"),
        F.array("lang", "source").alias("categories"), F.array(F.lit(" news "), F.lit(" ")).alias("tags"), null("array<string>").alias("media_asset_urls"),
        F.parse_json(F.to_json(F.struct(F.col("source").alias("region"), F.lit(" <b>EU</b> ").alias("zone"), F.lit(3).alias("level")))).alias("geographical_data"),
        F.lit("2024-12-31").cast("date").alias("embargo_date"), null("string").alias("sentiment"),
        every(7, F.lit(123)).cast("int").alias("word_count"), F.col("source").alias("publisher"),
        F.parse_json(F.to_json(meta)).alias("additional_metadata"))


def processed(spark, sf_dir):
    return preprocess(articles(spark, sf_dir), CFG, RUN_DATE, key_col="doc_id")


def _sql(e: str) -> str:
    return O.sql_clean(e, CFG.cleaning)


# ---- DuckDB twin of the processed record
SQL_TEXT, SQL_TITLE = TEXT.replace("STRING", "VARCHAR"), TITLE
SQL_ID = ID.replace("STRING", "VARCHAR")
PROCESSED = f"""SELECT doc_id, source, lang, {SQL_ID} AS document_id, {_sql(SQL_TEXT)} AS cleaned_text, {_sql(SQL_TITLE)} AS cleaned_title,
  CASE WHEN doc_id % 22 <> 0 THEN DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) END AS pub FROM documents"""
COUNTED = f"""SELECT *, CASE WHEN doc_id % 7 = 0 THEN 123 ELSE {O.sql_word_count('cleaned_text')} END AS wc,
  coalesce(pub, DATE '{RUN_DATE}') AS ref FROM ({PROCESSED})"""


@register(
    "preprocess_metadata_documents",
    sql=f"""SELECT document_id, '1.0' AS version, cleaned_text, cleaned_title, CAST(NULL AS VARCHAR) AS cleaned_excerpt, concat('by ', lang) AS cleaned_author,
  pub AS cleaned_publication_date, concat('https://', source, '.example.com/', CAST(doc_id AS VARCHAR)) AS cleaned_source_url,
  concat_ws('|', lang, source) AS categories, 'news' AS tags, source AS geo_region, 'EU' AS geo_zone, 3 AS geo_level, DATE '2024-12-31' AS cleaned_embargo_date,
  wc AS cleaned_word_count, source AS feed, 'wire' AS desk, false AS has_empty, concat_ws('|', 'a', lang) AS meta_list,
  CASE WHEN doc_id % 5 = 0 THEN 9 ELSE {O.sql_reading_time('wc')} END AS reading_time, CASE WHEN doc_id % 3 = 0 THEN 'xx' END AS language,
  CASE WHEN doc_id % 11 = 0 THEN strftime(ref - CAST((isodow(ref) - 1 - 4 + 6) % 7 + 1 AS INTEGER), '%Y-%m-%d') END AS temporal_metadata
FROM ({COUNTED})""",
)
def preprocess_metadata_documents(spark, sf_dir):
    """P1 with M1-M8, E4, E7 and E11 (supplied word counts, reading times and languages beat computed ones)."""
    p = processed(spark, sf_dir)
    meta, geo = F.col("cleaned_additional_metadata"), F.col("cleaned_geographical_data")
    get = lambda v, k, t: F.try_variant_get(v, f"$.{k}", t)
    return p.select(
        "document_id", "version", "cleaned_text", "cleaned_title", "cleaned_excerpt", "cleaned_author", "cleaned_publication_date", "cleaned_source_url",
        F.array_join("cleaned_categories", "|").alias("categories"), F.array_join("cleaned_tags", "|").alias("tags"),
        get(geo, "region", "string").alias("geo_region"), get(geo, "zone", "string").alias("geo_zone"), get(geo, "level", "int").alias("geo_level"),
        "cleaned_embargo_date", "cleaned_word_count", get(meta, "cleaned_feed", "string").alias("feed"), get(meta, "cleaned_desk", "string").alias("desk"),
        get(meta, "cleaned_empty", "string").isNotNull().alias("has_empty"), F.array_join(get(meta, "cleaned_list", "array<string>"), "|").alias("meta_list"),
        get(meta, "cleaned_reading_time", "int").alias("reading_time"), get(meta, "cleaned_language", "string").alias("language"), "temporal_metadata")


@register(
    "run_report_documents",
    sql=f"""SELECT count(*) AS documents_processed, CAST(0 AS BIGINT) AS total_entities, CAST(sum(wc) AS BIGINT) AS total_words FROM ({COUNTED})""",
)
def run_report_documents(spark, sf_dir):
    """Documents, entities and words of a run."""
    return processed(spark, sf_dir).agg(F.count("*").alias("documents_processed"), F.sum(F.size("entities")).alias("total_entities"),
                                        F.sum("cleaned_word_count").alias("total_words"))


# ---------------------------------------------------------------- sinks
@register("sink_jsonl_documents", sql=f"SELECT document_id, '1.0' AS version, cleaned_title, cleaned_text FROM ({PROCESSED})")
def sink_jsonl_documents(spark, sf_dir):
    """K1: result files with envelopes, read back."""
    path = scratch_path(spark, "sink-jsonl")
    K.write_results_jsonl(processed(spark, sf_dir), path)
    schema = "document_id string, version string, processed_data struct<cleaned_title:string,cleaned_text:string>"
    return spark.read.schema(schema).json(path).select("document_id", "version", "processed_data.*")


@register("sink_daily_jsonl_documents", sql=f"SELECT DATE '{RUN_DATE}' AS ingest_date, document_id, cleaned_text FROM ({PROCESSED})")
def sink_daily_jsonl_documents(spark, sf_dir):
    """K2: the day's partition."""
    path = scratch_path(spark, "sink-daily")
    K.write_daily_jsonl(processed(spark, sf_dir), path, RUN_DATE)
    return spark.read.schema("document_id string, cleaned_text string, ingest_date date").json(path).select("ingest_date", "document_id", "cleaned_text")


@register(
    "sink_sql_rows_documents",
    sql=f"""SELECT document_id, concat('["', lang, '","', source, '"]') AS categories, '["news"]' AS tags, '[]' AS entities,
  CASE WHEN doc_id % 11 = 0 THEN ref - CAST((isodow(ref) - 1 - 4 + 6) % 7 + 1 AS INTEGER) END AS temporal_metadata FROM ({COUNTED})""",
)
def sink_sql_rows_documents(spark, sf_dir):
    """K4: rows for a relational table, lists as JSON text; written and read back."""
    path = scratch_path(spark, "sink-sql")
    K.to_sql_row(processed(spark, sf_dir)).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows.select("document_id", F.col("cleaned_categories").alias("categories"), F.col("cleaned_tags").alias("tags"), "entities", F.col("temporal_metadata").cast("date").alias("temporal_metadata"))


@register(
    "upsert_documents",
    sql=f"""SELECT document_id, CASE WHEN doc_id % 3 = 0 THEN concat('new ', source) ELSE source END AS source,
  TIMESTAMP '2024-01-01 00:00:00' + CASE WHEN doc_id % 2 = 0 THEN INTERVAL 0 DAY ELSE INTERVAL 31 DAY END AS created_at,
  TIMESTAMP '2024-01-01 00:00:00' + CASE WHEN doc_id % 2 = 0 AND doc_id % 3 <> 0 THEN INTERVAL 0 DAY ELSE INTERVAL 31 DAY END AS updated_at
FROM (SELECT doc_id, source, {SQL_ID} AS document_id FROM documents) WHERE doc_id % 2 = 0 OR doc_id % 3 = 0""",
)
def upsert_documents(spark, sf_dir):
    """K3: two overlapping batches with repeated keys; the latest version wins, the first creation stays."""
    path = scratch_path(spark, "sink-table")
    d = table(spark, sf_dir, "documents").select("doc_id", F.expr(ID).alias("document_id"), "source")
    old = d.filter("doc_id % 2 = 0").withColumn("seq", F.lit(1))
    new = d.filter("doc_id % 3 = 0").withColumn("seq", F.explode(F.array(F.lit(3), F.lit(2))))
    new = new.withColumn("source", F.when(F.col("seq") == 3, F.concat(F.lit("new "), "source")).otherwise(F.lit("stale")))
    K.upsert(spark, old.drop("doc_id"), path, order_col="seq", now="2024-01-01 00:00:00", keep_order=False)
    t = K.upsert(spark, new.drop("doc_id"), path, order_col="seq", now="2024-02-01 00:00:00", keep_order=False)
    zone = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return t.select("document_id", "source", zone("created_at"), zone("updated_at"))


@register(
    "sink_index_bulks_documents",
    sql="""SELECT CAST(count(*) AS BIGINT) AS success, CAST(0 AS BIGINT) AS errors, true AS within_limit FROM documents""",
)
def sink_index_bulks_documents(spark, sf_dir):
    """K5: bulk files; counts are read from them."""
    counts = K.write_index_bulk(processed(spark, sf_dir), scratch_path(spark, "sink-bulk"))
    return counts.agg(F.sum("success").alias("success"), F.sum("errors").alias("errors"), (F.max("success") <= K.BULK_SIZE).alias("within_limit"))


@register(
    "sink_fan_out_documents",
    sql=f"""SELECT document_id, cleaned_title, sink FROM ({PROCESSED}), (SELECT unnest(['default', 'daily', 'jsonl']) AS sink)""",
)
def sink_fan_out_documents(spark, sf_dir):
    """K6: two sinks at once, and the default sink when none of the requested ones is enabled."""
    path, p = scratch_path(spark, "sink-fan"), materialize(processed(spark, sf_dir), "fan-processed", "zstd")  # for two calls
    K.fan_out(p, {"jsonl": {"path": f"{path}/jsonl"}, "daily_jsonl": {"folder": f"{path}/daily", "run_date": RUN_DATE}}, ["jsonl", "unknown", "daily_jsonl"], written=True)
    K.fan_out(p, {"daily_jsonl": {"folder": f"{path}/unused", "run_date": RUN_DATE}}, ["unknown"], default_path=f"{path}/default", written=True)
    wrapped = "document_id string, processed_data struct<cleaned_title:string>"
    read = lambda x: spark.read.schema(wrapped).json(f"{path}/{x}").select("document_id", "processed_data.cleaned_title", F.lit(x).alias("sink"))
    daily = spark.read.schema("document_id string, cleaned_title string").json(f"{path}/daily").select("document_id", "cleaned_title", F.lit("daily").alias("sink"))
    return read("jsonl").union(read("default")).union(daily)


@register("sink_user_documents", sql=f"SELECT split_part(document_id, '-', 1) AS prefix, document_id, length(cleaned_text) AS n_chars FROM ({PROCESSED})")
def sink_user_documents(spark, sf_dir):
    """K7: a sink that a user registers, beside a built-in one."""
    path = scratch_path(spark, "sink-user")
    short = lambda df: df.select("document_id", F.length("cleaned_text").cast("long").alias("n_chars"), F.split_part("document_id", F.lit("-"), F.lit(1)).alias("prefix"))
    K.register_sink("lengths", lambda folder, **_: (lambda df: short(df).write.partitionBy("prefix").parquet(folder)))
    done = K.fan_out(processed(spark, sf_dir), {"lengths": {"folder": f"{path}/lengths"}, "jsonl": {"path": f"{path}/jsonl"}}, ["lengths", "jsonl"])
    assert done == ["lengths", "jsonl"]
    return spark.read.schema("document_id string, n_chars long, prefix string").parquet(f"{path}/lengths").select("prefix", "document_id", "n_chars")


# ---------------------------------------------------------------- files
def _write_lines(spark, sf_dir, name, path=None):
    """The derived lines as several JSONL files, one for each ``doc_id % 4``, in doc_id order within each."""
    path = path or scratch_path(spark, name)
    lines = derived_lines(spark, sf_dir).withColumn("part", (F.col("line_number") - 1) % 4)
    lines.repartition(4, "part").sortWithinPartitions("part", "line_number").select("part", "value").write.partitionBy("part").text(path)
    return path


def _write_line_folders(spark, sf_dir, name):
    """The derived lines as one folder for each ``doc_id % 4``, whose files in the order of their names hold the lines in doc_id
    order: no task gets a whole folder. The documents are dealt out before the lines are made, which the sample of the ranges
    would else make, too."""
    path = scratch_path(spark, name)
    d = table(spark, sf_dir, "documents", spread_rows=False)
    tasks = max(d.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = d.withColumn("part", F.col("doc_id") % 4).repartitionByRange(tasks, "part", "doc_id").sortWithinPartitions("part", "doc_id")
    lines_of(d, "part").select("part", "value").write.partitionBy("part").text(path)
    return path


@register(
    "file_lines_documents",
    sql="""SELECT CAST(doc_id % 4 AS INTEGER) AS part, count(*) AS n_lines, count_if(doc_id % 10 = 2) AS n_blank,
  CAST(sum((doc_id // 4 + 1) * CASE WHEN doc_id % 10 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS blank_line_numbers FROM documents GROUP BY 1""",
)
def file_lines_documents(spark, sf_dir):
    """Real files, their line numbers and blank lines."""
    from textforge.sources.jsonl import read_lines
    from textforge.functions.urls import strip_ws

    lines = read_lines(spark, _write_line_folders(spark, sf_dir, "lines"), by_folder=True)
    blank = strip_ws(F.col("value")) == ""
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("int")
    return lines.groupBy(part.alias("part")).agg(F.count("*").alias("n_lines"), F.count_if(blank).alias("n_blank"),
                                                 F.sum(F.when(blank, F.col("line_number")).otherwise(0)).alias("blank_line_numbers"))


@register(
    "admission_documents",
    sql="""WITH b AS (SELECT doc_id % 4 AS part, (doc_id // 4) // 100 AS batch_id, count_if(doc_id % 10 <> 2) AS n FROM documents GROUP BY 1, 2)
SELECT CAST(part AS INTEGER) AS part, CAST(batch_id AS BIGINT) AS batch_id, n AS n_records, n BETWEEN 1 AND 85 AS accepted FROM b""",
)
def admission_documents(spark, sf_dir):
    """Batches of 100 lines against a limit of 85 records: those with fewer blank lines are refused."""
    from textforge.sources.jsonl import admission, read_lines

    a = admission(read_lines(spark, _write_line_folders(spark, sf_dir, "admission"), by_folder=True), 100, max_records=85)
    return a.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("int").alias("part"), "batch_id", "n_records", "accepted")


@register(
    "error_report_documents",
    sql="""SELECT count_if(kind = 'e') AS n_errors, count_if(kind = 'e') > 0 AS written, false AS written_without_errors FROM (
SELECT CASE WHEN doc_id % 10 = 0 AND (doc_id % 40 = 0 OR doc_id % 50 = 20) OR doc_id % 10 IN (3, 4, 5) OR doc_id % 30 = 9 THEN 'e' END AS kind FROM documents)""",
)
def error_report_documents(spark, sf_dir):
    """K8: the report is written if, and only if, there are errors; all of them are in it."""
    from textforge.plans.q_ingest import derived_lines
    from textforge.session import materialize

    path = scratch_path(spark, "report")
    c = materialize(I.classify(derived_lines(spark, sf_dir)), "report-lines")
    wrote = K.write_error_report(I.run_summary(c), I.quarantine(c), f"{path}/all")
    fine = c.filter("status in ('valid', 'empty')")
    other = K.write_error_report(I.run_summary(fine), I.quarantine(fine), f"{path}/none")
    errors = spark.read.schema("error_type string").json(f"{path}/all/errors")
    return errors.agg(F.count("*").alias("n_errors"), F.lit(wrote).alias("written"), F.lit(other).alias("written_without_errors"))


@register(
    "metadata_typos_documents",
    sql=f"""SELECT {SQL_ID} AS document_id, 'the weekly report' AS title, 'the desk|{chr(39)}{chr(39)}quoted{chr(39)}{chr(39)} news' AS tags, 'north region' AS zone, 'the wire' AS desk,
  'the first|second' AS list, 'teh text' AS cleaned_text FROM documents""",
)
def metadata_typos_documents(spark, sf_dir):
    """M1-M5 with typo correction and encoding repair of strings, lists and maps; the call's override is for the text only."""
    words = spark.createDataFrame([(w, 50) for w in "the weekly report desk quoted news north region wire first second text".split()], "word string, freq long")
    a = articles(spark, sf_dir).withColumns({
        "text": F.lit("teh text"), "title": F.lit("teh weekly  reoprt"), "tags": F.array(F.lit("teh desk"), F.lit("\u2018quoted\u2019 nwes"), F.lit("")),
        "geographical_data": F.parse_json(F.lit('{"zone": "norht region", "n": 1}')),
        "additional_metadata": F.parse_json(F.lit('{"desk": "teh wire", "list": ["teh first", 5, "secnod"]}'))})
    cfg = PipelineConfig(cleaning=CleaningConfig.settings_default(), entity_recognition=False)
    p = preprocess(a, cfg, RUN_DATE, dictionary=words, key_col="doc_id", override={"enable_typo_correction": False})
    meta, geo = F.col("cleaned_additional_metadata"), F.col("cleaned_geographical_data")
    return p.select("document_id", F.col("cleaned_title").alias("title"), F.array_join("cleaned_tags", "|").alias("tags"),
                    F.try_variant_get(geo, "$.zone", "string").alias("zone"), F.try_variant_get(meta, "$.cleaned_desk", "string").alias("desk"),
                    F.array_join(F.try_variant_get(meta, "$.cleaned_list", "array<string>"), "|").alias("list"), "cleaned_text")


# ---------------------------------------------------------------- encoding, user steps, find by id, validation messages, streams
@register("encoding_repair_documents", sql="SELECT doc_id, text AS repaired FROM documents")
def encoding_repair_documents(spark, sf_dir):
    """Texts whose UTF-8 bytes were read as Latin-1, once or twice, come back as they were."""
    from textforge.functions.encoding import fix_encoding

    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    damage = lambda c: F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    once = damage(F.col("text"))
    d = d.select("doc_id", F.when(F.col("doc_id") % 2 == 0, once).otherwise(damage(once)).alias("t"))
    return d.select("doc_id", fix_encoding(F.col("t")).alias("repaired"))


@register("user_step_documents", sql=f"SELECT doc_id, {O.sql_clean('text', CFG.cleaning)} AS cleaned FROM documents")
def user_step_documents(spark, sf_dir):
    """A registered step takes symbols out that were put in."""
    from textforge.functions.clean import clean_text

    cfg = CFG.cleaning.merge({"extra_steps": ["remove_emoji"], "normalize_punctuation": False})
    plain = CFG.cleaning
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("\U0001F600"), "text", F.lit("\U0001F680")).alias("t"))
    d = d.select("doc_id", clean_text("t", cfg).alias("t"))
    return d.select("doc_id", clean_text("t", plain).alias("cleaned"))


@register("find_document_by_id", sql=f"SELECT document_id, cleaned_title, cleaned_text FROM ({PROCESSED}) WHERE document_id = 'doc-7'")
def find_document_by_id(spark, sf_dir):
    """One processed record by its id."""
    return processed(spark, sf_dir).filter("document_id = 'doc-7'").select("document_id", "cleaned_title", "cleaned_text")


@register(
    "validation_messages_jsonl",
    sql="""SELECT line_number, loc, msg FROM (SELECT doc_id + 1 AS line_number, CASE doc_id % 10 WHEN 4 THEN 'text' WHEN 5 THEN 'document_id'
  WHEN 0 THEN CASE WHEN doc_id % 40 = 0 THEN 'publication_date' ELSE 'word_count' END END AS loc, CASE doc_id % 10 WHEN 4 THEN 'Field required' WHEN 5 THEN 'Input should be a valid string'
  WHEN 0 THEN CASE WHEN doc_id % 40 = 0 THEN 'Input should be a valid date' ELSE 'Input should be a valid integer' END END AS msg
FROM documents WHERE doc_id % 10 IN (4, 5) OR doc_id % 40 = 0 OR doc_id % 50 = 20) ORDER BY line_number LIMIT 10""",
)
def validation_messages_jsonl(spark, sf_dir):
    """The first ten validation messages (the report's limit), in line order."""
    c = I.classify(derived_lines(spark, sf_dir), repair=False).filter("error_type = 'ValidationError'")
    first = c.orderBy("line_number").limit(10)
    e = F.get("errors", F.lit(0))
    return first.select("line_number", e["loc"].alias("loc"), e["msg"].alias("msg"))


@register(
    "stream_ingest_documents",
    sql=f"""WITH x AS ({EXPECTED})
SELECT document_id, {O.sql_clean('text', CFG.cleaning)} AS cleaned_text FROM x WHERE status = 'valid'""",
)
def stream_ingest_documents(spark, sf_dir):
    """The lines as files through the stream, batch by batch, into the keyed table: the same as one batch."""
    from textforge.streaming.ingest import start_ingest_stream

    base = scratch_path(spark, "stream")
    source = _write_lines(spark, sf_dir, "stream-in")
    query = start_ingest_stream(spark, source, f"{base}/table", f"{base}/quarantine", f"{base}/checkpoint", CFG, RUN_DATE, max_files_per_trigger=2)
    query.awaitTermination()
    return K.read_table(spark, f"{base}/table").select("document_id", "cleaned_text")


@register(
    "stream_redelivery_documents",
    sql=f"""WITH x AS ({EXPECTED})
SELECT document_id, {O.sql_clean('text', CFG.cleaning)} AS cleaned_text, false AS written_again FROM x WHERE status = 'valid'""",
)
def stream_redelivery_documents(spark, sf_dir):
    """Every file comes twice under other names at once, and again in a later run: the table of one delivery, not written again."""
    from textforge.streaming.ingest import start_ingest_stream

    base = scratch_path(spark, "redelivery")

    def deliver(*names):
        for name in names:
            _write_lines(spark, sf_dir, name, f"{base}/in/{name}")
        start_ingest_stream(spark, f"{base}/in", f"{base}/table", f"{base}/quarantine", f"{base}/checkpoint", CFG, RUN_DATE, redelivery_window="7 days").awaitTermination()
        return K.versions(spark, f"{base}/table")

    first = deliver("one", "copy")
    again = deliver("late")
    return K.read_table(spark, f"{base}/table").select("document_id", "cleaned_text", F.lit(first != again).alias("written_again"))
