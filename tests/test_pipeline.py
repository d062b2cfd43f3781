"""P1, sinks, upsert, streaming, and the driver contract."""

import json
import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def _articles(spark):
    from textforge.plans.q_preprocess import articles_from_documents

    return articles_from_documents(spark, SF_SMALL)


def test_preprocess_schema_and_values(spark):
    from textforge.config import CleaningConfig, PipelineConfig
    from textforge.plans.preprocess import OUTPUT_COLUMNS, preprocess

    cfg = PipelineConfig(cleaning=CleaningConfig.settings_default().merge({"enable_typo_correction": False}),
                         entity_recognition=True)
    out = preprocess(_articles(spark), cfg, "2024-06-01", key_col="doc_id")
    assert tuple(out.columns) == OUTPUT_COLUMNS
    r = out.orderBy("document_id").first()
    assert r.version == "1.0" and r.cleaned_word_count > 0
    meta = json.loads(r.cleaned_additional_metadata.toJson())
    assert meta["cleaned_desk"] == "wire" and meta["cleaned_reading_time"] >= 1
    assert r.cleaned_tags == ["news"]
    geo = json.loads(r.cleaned_geographical_data.toJson())
    assert geo["zone"] == "EU"


def test_upsert_keeps_created_at(spark, tmp_dir):
    from textforge.sinks.writers import read_table, upsert

    t = f"{tmp_dir}/table"
    v1 = spark.createDataFrame([("a", "one", 1), ("b", "two", 1)], "document_id string, cleaned_text string, seq int")
    upsert(spark, v1, t, order_col="seq", now="2024-01-01 00:00:00")
    v2 = spark.createDataFrame([("b", "TWO-final", 2), ("b", "TWO", 1), ("c", "three", 1)], v1.schema)
    for _ in range(2):  # repeating a batch changes nothing but updated_at
        upsert(spark, v2, t, order_col="seq", now="2024-02-01 00:00:00")
    cur = {r.document_id: r for r in read_table(spark, t).collect()}
    assert set(cur) == {"a", "b", "c"} and cur["b"].cleaned_text == "TWO-final"
    assert str(cur["b"].created_at).startswith("2024-01-01") and str(cur["b"].updated_at).startswith("2024-02-01")
    assert str(cur["c"].created_at).startswith("2024-02-01")


def test_upsert_touches_only_its_buckets_and_cleans_up(spark, tmp_dir):
    from textforge.sinks.writers import _read_manifest, read_table, upsert, versions

    t = f"{tmp_dir}/table"
    many = spark.range(200).selectExpr("cast(id as string) as document_id", "id as v", "1 as _order")
    upsert(spark, many, t, order_col="_order", keep_order=False, buckets=8)
    before = _read_manifest(spark, t, versions(spark, t)[-1])["paths"]
    for n in range(4):
        upsert(spark, many.filter("document_id = '7'").withColumn("v", F.lit(1000 + n).cast("long")), t, order_col="_order", keep_order=False)
    after = _read_manifest(spark, t, versions(spark, t)[-1])["paths"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(versions(spark, t)) == 2
    assert len(os.listdir(f"{t}/data")) <= 3
    rows = {r.document_id: r.v for r in read_table(spark, t).collect()}
    assert len(rows) == 200 and rows["7"] == 1003 and rows["8"] == 8 and "_order" not in read_table(spark, t).columns


def test_upsert_that_stops_loses_nothing(spark, tmp_dir, monkeypatch):
    import pytest

    from textforge.sinks import writers

    t = f"{tmp_dir}/table"
    row = lambda k: spark.createDataFrame([(k, 1)], "document_id string, seq int")
    writers.upsert(spark, row("x"), t, order_col="seq")
    add = writers._add_manifest
    with monkeypatch.context() as m:  # stops after the data are written, before the manifest
        m.setattr(writers, "_add_manifest", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            writers.upsert(spark, row("y"), t, order_col="seq")
    assert {r.document_id for r in writers.read_table(spark, t).collect()} == {"x"}
    writers.upsert(spark, row("z"), t, order_col="seq")
    assert {r.document_id for r in writers.read_table(spark, t).collect()} == {"x", "z"}
    with pytest.raises(RuntimeError):  # a version is never written twice
        add(spark, t, writers.versions(spark, t)[-1], {})
    os.makedirs(f"{tmp_dir}/other/data/abc")
    with pytest.raises(ValueError):
        writers.read_table(spark, f"{tmp_dir}/other")


def test_sink_selection():
    from textforge.sinks.writers import select_backends

    assert select_backends(None, ["jsonl"]) == ["jsonl"]
    assert select_backends(["postgresql", "jsonl"], ["jsonl", "table"]) == ["jsonl"]
    assert select_backends(["nope"], ["table"]) == ["jsonl"] == select_backends(None, [])


def test_jsonl_and_index_sinks(spark, tmp_dir):
    from textforge.config import CleaningConfig, PipelineConfig
    from textforge.plans.preprocess import preprocess
    from textforge.sinks.writers import write_index_bulk, write_results_jsonl

    cfg = PipelineConfig(cleaning=CleaningConfig(fix_encoding=False, enable_typo_correction=False),
                         entity_recognition=False)
    p = preprocess(_articles(spark).limit(5), cfg, "2024-06-01", key_col="doc_id")
    write_results_jsonl(p, f"{tmp_dir}/out")
    back = spark.read.json(f"{tmp_dir}/out")
    assert back.count() == 5 and "processed_data" in back.columns
    counts = write_index_bulk(p, f"{tmp_dir}/bulk")
    assert [(r.success, r.errors) for r in counts.collect()] and counts.agg(F.sum("success"), F.sum("errors")).first()[:] == (5, 0)
    lines = spark.read.text(f"{tmp_dir}/bulk").collect()
    assert len(lines) == 10 and json.loads(lines[0].value)["index"]["_id"].startswith("doc-")


def test_streaming_equals_batch(spark, tmp_dir):
    from textforge.config import CleaningConfig, PipelineConfig
    from textforge.sinks.writers import read_table
    from textforge.streaming.ingest import start_ingest_stream

    src = f"{tmp_dir}/in"
    os.makedirs(src)
    for f in range(4):
        with open(f"{src}/f{f}.jsonl", "w") as fh:
            for i in range(3):
                fh.write(json.dumps({"document_id": f"d{(f + i) % 6}", "text": f"v{f} text {i}"}) + "\n")
            fh.write("not json\n")
        os.utime(f"{src}/f{f}.jsonl", (1_700_000_000 + f * 100, 1_700_000_000 + f * 100))  # file-source order
    cfg = PipelineConfig(cleaning=CleaningConfig(fix_encoding=False, enable_typo_correction=False),
                         entity_recognition=False)
    q = start_ingest_stream(spark, src, f"{tmp_dir}/table", f"{tmp_dir}/quarantine", f"{tmp_dir}/ckpt", cfg,
                            "2024-06-01", max_files_per_trigger=1)
    q.awaitTermination(300)
    rows = {r.document_id: r.cleaned_text for r in read_table(spark, f"{tmp_dir}/table").collect()}
    assert set(rows) == {f"d{k}" for k in range(6)}
    # file f3 is the last batch: d3, d4, d5 come from it; d0..d2 from earlier files
    assert rows["d5"] == "v3 text 2" and rows["d3"] == "v3 text 0"
    assert spark.read.parquet(f"{tmp_dir}/quarantine").count() == 4


def test_files_delivered_again_are_left_out(spark, tmp_dir):
    from textforge.config import CleaningConfig, PipelineConfig
    from textforge.sinks.writers import read_table, versions
    from textforge.streaming.ingest import start_ingest_stream

    src, t = f"{tmp_dir}/in", f"{tmp_dir}/table"
    os.makedirs(f"{src}/sub")
    cfg = PipelineConfig(cleaning=CleaningConfig(fix_encoding=False, enable_typo_correction=False), entity_recognition=False)

    def put(name, *texts):
        with open(f"{src}/{name}", "w") as fh:
            fh.write("".join(json.dumps({"document_id": t[0], "text": t}) + "\n" for t in texts))

    def run():
        start_ingest_stream(spark, src, t, f"{tmp_dir}/quarantine", f"{tmp_dir}/ckpt", cfg, "2024-06-01", max_files_per_trigger=2,
                            redelivery_window="1 hour").awaitTermination(300)
        return versions(spark, t)[-1], {r.document_id: r.cleaned_text for r in read_table(spark, t).collect()}

    put("one.jsonl", "a first", "b first")
    put("sub/copy.jsonl", "a first", "b first")
    assert run() == (1, {"a": "a first", "b": "b first"})
    put("again.jsonl", "a first", "b first")
    put("sub/empty.jsonl")
    number, rows = run()
    assert rows == {"a": "a first", "b": "b first"} and number <= 2
    put("two.jsonl", "b second", "c second")
    put("old.jsonl", "a first", "b first")
    day = os.path.getmtime(f"{src}/old.jsonl") - 86_400
    os.utime(f"{src}/two.jsonl", (day, day))  # older than the window, but not late: the time that counts is that of its coming
    assert run()[1] == {"a": "a first", "b": "b second", "c": "c second"}


def test_digests_of_files_take_no_content_into_memory(spark, tmp_dir):
    """Files longer than the binary source may read, with odd names: as before, one of each content."""
    from textforge.streaming.ingest import file_digest, read_new_files

    import hashlib

    os.makedirs(f"{tmp_dir}/in/a b")
    long = b"\xff\r\n" + "é".encode() * 1_500_000
    for name, content in (("a b/x%20y.jsonl", long), ("z:1.jsonl", long), ("other.jsonl", long[:-2] + b"ab")):
        with open(f"{tmp_dir}/in/{name}", "wb") as f:
            f.write(content)
    assert file_digest(f"file:{tmp_dir}/in/a b/x%20y.jsonl") == file_digest(f"file://{tmp_dir}/in/z:1.jsonl") == hashlib.sha256(long).hexdigest()
    most = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(most, "1000")
    try:
        found = []
        (read_new_files(spark, f"{tmp_dir}/in", "1 hour").writeStream.option("checkpointLocation", f"{tmp_dir}/cp").trigger(availableNow=True)
         .foreachBatch(lambda df, _: found.extend(r.file for r in df.collect())).start().awaitTermination(300))
    finally:
        spark.conf.unset(most)
    assert len(found) == 2 and [x for x in found if x.endswith("other.jsonl")]


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"lang", "n_docs", "total_words", "total_reading_minutes"}
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 30


def test_oracle_small(spark):
    """A few queries against their DuckDB twin at sf0.001."""
    import duckdb

    import __spark_entry__ as E
    from tools.check_oracle import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    for name in ("clean_documents", "currency_lineitem", "date_normalize_orders", "ingest_documents_jsonl",
                 "typo_correct_documents", "entities_orders", "language_detect_documents"):
        df = qs[name](spark, SF_SMALL)
        res = con.execute(sqls[name])
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == \
            rows_of([d[0] for d in res.description], res.fetchall()), name


def test_scratch_is_removed_on_request(spark):
    from textforge import session

    kept, session._SCRATCH[:] = list(session._SCRATCH), []
    df = session.materialize(spark.range(5), "scratch-test")
    path = session._SCRATCH[0].removeprefix("file://")
    assert df.count() == 5 and os.path.isdir(path)
    assert session.remove_scratch(spark) == 1 and not os.path.exists(path) and session.remove_scratch(spark) == 0
    session._SCRATCH[:] = kept
