"""S3-S7 parsing and repair, and the ingest classification."""

import json

import pytest
from pyspark.sql import functions as F

from textforge.functions.jsonrepair import escape_stray_quotes, extract_fields, fix_unicode
from textforge.sources.jsonl import parse_lines


def repair(spark, *lines):
    """(object or None, error, strategy) of each line."""
    df = spark.createDataFrame(list(enumerate(lines)), "line_number long, value string")
    rows = parse_lines(df).select("line_number", F.to_json("parsed").alias("j"), "json_error", "repair_strategy").orderBy("line_number").collect()
    return [(json.loads(r.j) if r.j else None, r.json_error, r.repair_strategy) for r in rows]


def test_strategies(spark):
    got = repair(
        spark,
        '{"document_id":"bad-002","text":"Price is $100—very expensive"}',
        '{"document_id":"bad-001","text":"He said "hello" to me"}',
        '{"document_id":"u","text":“\x01plain”}'.replace("“", '"“').replace("”", '”"'),
        '{"document_id":"b","text":"\x02say "hi" now…"}',
        '{"document_id":"c","text":"cut off, with "quotes", here',
        "not json at all",
    )
    assert [k for _, _, k in got] == [1, 2, 3, 4, 5, None]
    assert got[0][0]["text"].endswith("very expensive")
    assert got[1][0]["text"] == 'He said "hello" to me'
    assert got[2][0]["text"] == '"plain"'
    assert got[3][0]["text"] == 'say "hi" now...'
    assert got[4][0] == {"document_id": "c", "text": 'cut off, with "quotes'}
    assert got[5][0] is None and got[5][1].startswith("All parsing failed. Expecting value at position 0")


@pytest.mark.parametrize("line,fixed", [
    ('{"tags":["a","b"]}', '{"tags":["a","b\\"]}'),
    ('{"a":"x "y" z","b":"c"}', '{"a":"x \\"y\\" z","b":"c"}'),
    ('{"a" : "x\\"y", "k"ey":1}', '{"a" : "x\\"y", "k\\"ey":1}'),
    ('{"a":"colon": inside","b":1}', '{"a":"colon\\": inside","b":1}'),
    ("", ""), ('"', '"'), ('{"a":"open \\', '{"a":"open \\'),
])
def test_quote_repair(line, fixed):
    assert escape_stray_quotes(line) == fixed


def test_quote_repair_of_a_long_line_is_linear():
    line = '{"document_id":"d","text":"' + 'say "x" and ' * 40_000 + '"}'
    assert json.loads(escape_stray_quotes(line))["text"] == 'say "x" and ' * 40_000


def test_classify_lines(spark):
    from textforge.plans.ingest import classify, quarantine, run_summary

    lines = [
        '{"document_id":"ok-1","text":"fine","publication_date":"2024-01-02","word_count":"12"}',
        '{"document_id":"bad-001","text":"He said "hello" to me"}',
        "",
        "   ",
        "null",
        "123",
        "[1]",
        '{"a":1} trailing',
        '{"document_id":"x"}',
        '{"document_id":5,"text":"t"}',
        '{"document_id":"d","text":"t","word_count":10.5}',
        '{"document_id":"u","text":"t","source_url":"httpss://example.com/a"}',
        '{"document_id":"v","text":"t","source_url":"nonsense"}',
    ]
    df = spark.createDataFrame([(i + 1, v) for i, v in enumerate(lines)], "line_number long, value string")
    c = classify(df)
    st = {r.line_number: r for r in c.collect()}
    assert st[1].status == "valid" and st[1].word_count == 12 and str(st[1].publication_date) == "2024-01-02"
    assert st[2].status == "valid" and st[2].repair_strategy == 2
    assert st[3].status == "empty" and st[4].status == "empty"
    assert all(st[i].status == "json_error" for i in (5, 6, 7, 8))
    assert st[5].document_id == "line-5"
    assert all(st[i].status == "validation_error" for i in (9, 10, 11))
    assert st[10].document_id == "5"
    assert st[12].status == "valid" and st[12].source_url == "https://example.com/a"
    assert st[13].status == "valid" and st[13].source_url is None
    s = run_summary(c).first()
    assert s.total_lines == 13 and s.empty_lines == 2
    assert s.processed_successfully + s.total_errors + s.empty_lines == s.total_lines
    assert quarantine(c).count() == s.total_errors


def test_line_numbers_from_files(spark, tmp_dir):
    from textforge.sources.jsonl import read_lines

    want = {}
    for f in range(3):
        rows = [f'{{"document_id":"f{f}-{i}","text":"x"}}' if i % 5 else "" for i in range(400 + f * 37)]
        p = f"{tmp_dir}/part{f}.jsonl"
        with open(p, "w") as fh:
            fh.write("\n".join(rows) + "\n")
        for i, r in enumerate(rows, 1):
            want[(p, i)] = r
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_lines(spark, tmp_dir).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {(r.file.replace("file://", "").replace("file:", ""), r.line_number): r.value for r in got}
    assert got == want


def test_extraction_and_unicode_table(spark):
    lines = ['{"document_id":"d1","text":"line\\nnext "q" end","title":"T"} junk',
             '{"document_id":"d2","text":"' + "word " * 50000 + '"}',
             '{"document_id":"d3","text":"trunc', 'a“b”—c\u200bd\x01']
    df = spark.createDataFrame([(v,) for v in lines], "v string")
    got = df.select(extract_fields(F.col("v")).alias("x"), fix_unicode(F.col("v")).alias("u")).collect()
    assert (got[0].x.document_id, got[0].x.text, got[0].x.title) == ("d1", 'line\\nnext "q" end', "T")
    assert got[1].x.text == "word " * 50000 and got[2].x.text == "trunc" and got[3].x.text is None
    assert got[3].u == 'a\\"b\\"--cd'
