import hashlib

import pytest

from textforge.llm.warc import MAGIC, read_warc, records, write_warc

SCHEMA = "page_id long, url string, html string, file string, off int"
FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def expected(rows):
    first = {}
    for p, _, h, *_ in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, u, h, *_ in rows:
        if p is not None:
            b = (h or "").encode()
            again = len(b) >= 100 and first[h or ""] != p
            out.append((p, (u or "").replace("\r", "%0D").replace("\n", "%0A") or None, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None, b"" if again else b))
    return sorted(out, key=str)


def turn(spark, rows, folder, parts=2, split=None):
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        write_warc(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts), folder)
        return sorted([(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in records(read_warc(spark, folder)).collect()], key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


CASES = [(1, "http://a", "x" * 150), (2, None, "x" * 150), (3, "u\r\nWARC/1.0\r\n", None), (4, "", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", "no id"),
         (7, "u", FAKE * 3), (8, "u", "é" * 60 + "\r\n\r\nWARC/1.0\r\n"), (9, "u", FAKE * 3), (10, "u", "WARC/1.0\r\n" * 30), (11, "u", "y" * 9000 + FAKE + "z" * 9000), (1, "again", "x" * 150)]


@pytest.mark.parametrize("split", [None, 97])
def test_round_trip(spark, tmp_dir, split):
    assert turn(spark, CASES, tmp_dir + "/w", 2, split) == expected(CASES)


def test_many_records_over_many_splits(spark, tmp_dir):
    rows = [(i, f"http://h/{i}", ("p%d " % i) * (i % 60) + (FAKE if i % 7 == 0 else "")) for i in range(300)]
    assert turn(spark, rows, tmp_dir + "/w", 1, 2000) == expected(rows)


def test_empty_table(spark, tmp_dir):
    assert turn(spark, [], tmp_dir + "/w") == []


def test_damaged_archive_ends_where_the_chain_breaks(spark, tmp_dir):
    (open(tmp_dir + "/a.warc", "wb")).write(FAKE.encode() + FAKE.encode().replace(b"Content-Length: 3", b"Content-Length: 7") + FAKE.encode())
    assert MAGIC and records(read_warc(spark, tmp_dir + "/a.warc")).count() == 1
