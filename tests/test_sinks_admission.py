"""K2, K4, K6, K8 sinks and S12 admission."""

import json
import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def _processed(spark):
    from textforge.config import CleaningConfig, PipelineConfig
    from textforge.plans.preprocess import preprocess
    from textforge.plans.q_preprocess import articles_from_documents

    cfg = PipelineConfig(cleaning=CleaningConfig(fix_encoding=False, enable_typo_correction=False),
                         entity_recognition=False)
    return preprocess(articles_from_documents(spark, SF_SMALL).limit(7), cfg, "2024-06-01", key_col="doc_id")


def test_fan_out_and_report(spark, tmp_dir):
    from textforge.plans.ingest import classify, quarantine, run_summary
    from textforge.sinks.writers import fan_out, read_table, to_sql_row, write_error_report

    p = _processed(spark)
    fan_out(p, {"jsonl": {"path": f"{tmp_dir}/out"},
                "daily_jsonl": {"folder": f"{tmp_dir}/daily", "run_date": "2024-06-01"},
                "table": {"table_path": f"{tmp_dir}/tbl", "order_col": "cleaned_publication_date"}})
    assert fan_out(p, {}, ["nope"], default_path=f"{tmp_dir}/default") == ["jsonl"]
    assert spark.read.json(f"{tmp_dir}/default").count() == 7
    assert spark.read.json(f"{tmp_dir}/out").count() == 7
    assert os.path.isdir(f"{tmp_dir}/daily/ingest_date=2024-06-01")
    assert read_table(spark, f"{tmp_dir}/tbl").count() == 7
    sql_row = to_sql_row(p).first()
    assert isinstance(sql_row.entities, str) and json.loads(sql_row.cleaned_categories)

    lines = spark.createDataFrame([(1, '{"document_id":"a","text":"t"}'), (2, "oops")], "line_number long, value string")
    c = classify(lines)
    assert write_error_report(run_summary(c), quarantine(c), f"{tmp_dir}/report")
    fine = c.filter("status = 'valid'")
    assert not write_error_report(run_summary(fine), quarantine(fine), f"{tmp_dir}/none") and not os.path.exists(f"{tmp_dir}/none")
    s = spark.read.json(f"{tmp_dir}/report/summary").first()
    assert s.total_errors == 1 and s.success_rate == "50.0%"
    assert spark.read.json(f"{tmp_dir}/report/errors").first().error_type == "JSONDecodeError"


def test_admission(spark, tmp_dir):
    from textforge.sources.jsonl import admission, file_admission, read_lines

    with open(f"{tmp_dir}/a.jsonl", "w") as fh:
        fh.write("\n".join('{"document_id":"%d","text":"x"}' % i for i in range(1001)) + "\n\n")
    lines = read_lines(spark, f"{tmp_dir}/a.jsonl")
    batches = {r.batch_id: (r.n_records, r.accepted) for r in admission(lines, 1000).collect()}
    assert batches == {0: (1000, True), 1: (1, True)}
    whole = {r.batch_id: r.accepted for r in admission(lines, 2000).collect()}
    assert whole == {0: False}
    assert not file_admission(spark, f"{tmp_dir}/a.jsonl", max_bytes=100).first().accepted
    files = file_admission(spark, f"{tmp_dir}/a.jsonl").collect()
    assert len(files) == 1 and files[0].accepted and files[0].file_size > 0


def test_lines_are_numbered_over_the_files_of_a_folder(spark, tmp_dir):
    from textforge.sources.jsonl import read_lines

    for name, lines in (("a/part-00001-x.txt", "cd"), ("a/part-00000-x.txt", "ab"), ("b/part-00000-x.txt", "e")):
        os.makedirs(os.path.dirname(f"{tmp_dir}/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/{name}", "w") as fh:
            fh.writelines(f"{x}\n" for x in lines)
    rows = read_lines(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"], by_folder=True).collect()
    assert {(os.path.basename(r.file), r.line_number, r.value) for r in rows} == {("a", 1, "a"), ("a", 2, "b"), ("a", 3, "c"), ("a", 4, "d"), ("b", 1, "e")}


def test_no_task_writes_a_whole_folder_of_lines(spark, tmp_dir):
    from textforge.plans.q_sinks import _write_line_folders, admission_documents, file_lines_documents

    spark.range(400).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "'web' as source", "9L as n_chars").write.parquet(f"{tmp_dir}/documents.parquet")
    path = _write_line_folders(spark, tmp_dir, "test-lines")
    for part in range(4):
        assert sum(f.endswith(".txt") for f in os.listdir(f"{path}/part={part}")) > 1
    blank = [[i // 4 + 1 for i in range(p, 400, 4) if i % 10 == 2] for p in range(4)]
    assert {tuple(r) for r in file_lines_documents(spark, tmp_dir).collect()} == {(p, 100, len(x), sum(x)) for p, x in enumerate(blank)}
    assert {tuple(r) for r in admission_documents(spark, tmp_dir).collect()} == {(p, 0, 100 - len(x), 100 - len(x) <= 85) for p, x in enumerate(blank)}


def test_fan_out_query_processes_once(spark, tmp_dir, monkeypatch):
    from textforge.plans import q_sinks

    spark.range(5).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "'web' as source", "9L as n_chars").write.parquet(f"{tmp_dir}/documents.parquet")
    plans, fan_out = [], q_sinks.K.fan_out
    monkeypatch.setattr(q_sinks.K, "fan_out", lambda p, *a, **k: (plans.append(p._jdf.queryExecution().optimizedPlan().toString()), fan_out(p, *a, **k))[1])
    assert q_sinks.sink_fan_out_documents(spark, tmp_dir).count() == 15
    assert len(plans) == 2 and not any("regexp_replace" in p for p in plans)


def test_fan_out_query_writes_one_intermediate_copy(spark, tmp_dir, monkeypatch):
    """The processed records are written once for both calls; fan_out itself writes a copy only of what is not written yet."""
    from textforge.plans import q_sinks
    from textforge.sinks import writers

    spark.range(5).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "'web' as source", "9L as n_chars").write.parquet(f"{tmp_dir}/documents.parquet")
    copies, plain = [], writers.materialize
    for module in (writers, q_sinks):
        monkeypatch.setattr(module, "materialize", lambda df, name, *a: (copies.append(name), plain(df, name, *a))[1])
    rows = q_sinks.sink_fan_out_documents(spark, tmp_dir).collect()
    assert copies == ["fan-processed"] and sorted(r.sink for r in rows) == ["daily"] * 5 + ["default"] * 5 + ["jsonl"] * 5
    writers.fan_out(q_sinks.processed(spark, tmp_dir), {"jsonl": {"path": f"{tmp_dir}/out"}})
    assert copies == ["fan-processed", "fan-out"] and spark.read.json(f"{tmp_dir}/out").count() == 5
