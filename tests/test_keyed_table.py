"""K3: the keyed table against a plain dictionary, its splits, deltas, null keys and rival writers."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from textforge.sinks import writers as K


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_random_batches_against_a_dictionary(spark, tmp_dir):
    """Small buckets, so that they split unevenly while batches come and go; keys repeat, some are null."""
    rng, t, want = np.random.default_rng(1), f"{tmp_dir}/t", {}
    for n in range(7):
        rows = [(None if rng.random() < 0.05 else f"k{rng.zipf(1.3) % 300}", int(rng.integers(0, 5)), f"{n}-{i}" + "x" * int(rng.integers(0, 300))) for i in range(150)]
        now = f"2024-01-0{n + 1} 00:00:00"
        got = K.upsert(spark, spark.createDataFrame(rows, "document_id string, seq int, v string").coalesce(1), t, order_col="seq", now=now, buckets=2, max_bytes=4000)
        for k, s, v in sorted(rows, key=lambda r: r[1]):
            want[k] = (v, want.get(k, (None, now))[1], now)
        assert {r.document_id: (r.v, str(r.created_at), str(r.updated_at)) for r in got.collect()} == want
        assert got.count() == len(want)
    leaves = K._read_manifest(spark, t, K.versions(spark, t)[-1])["leaves"]
    assert len({len(x) for x in leaves}) > 1 or len(leaves) > 4
    assert sum(2.0 ** -len(x) for x in leaves) == 1  # they cover all hashes, each once


def test_a_small_batch_writes_little(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    many = spark.range(40_000).select(F.col("id").cast("string").alias("document_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("seq"))
    K.upsert(spark, many, t, order_col="seq", buckets=8)
    whole, before = size(f"{t}/data"), set(os.listdir(f"{t}/data"))
    got = K.upsert(spark, many.filter("cast(document_id as int) % 100 = 0").withColumn("v", F.lit("new")), t, order_col="seq")
    new = sum(size(f"{t}/data/{x}") for x in set(os.listdir(f"{t}/data")) - before)
    assert new < 0.03 * whole and before <= set(os.listdir(f"{t}/data"))
    assert got.count() == 40_000 and got.filter("v = 'new'").count() == 400


def test_null_keys_once_and_empty_batches(spark, tmp_dir):
    t, schema = f"{tmp_dir}/t", "document_id string, seq int"
    for _ in range(3):
        got = K.upsert(spark, spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], schema), t, order_col="seq")
        assert sorted((str(r.document_id), r.seq) for r in got.collect()) == [("None", 2), ("a", 1)]
    assert K.upsert(spark, spark.createDataFrame([], schema), t, order_col="seq").count() == 2


def test_new_columns_and_clashing_names(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    K.upsert(spark, spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "document_id string, seq int, _version int"), t, order_col="seq")
    got = K.upsert(spark, spark.createDataFrame([("b", 1, "x")], "document_id string, seq int, more string"), t, order_col="seq")
    assert {(r.document_id, r.more) for r in got.collect()} == {("a", None), ("b", "x")}


def test_of_two_writers_one_wins(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    K.upsert(spark, spark.createDataFrame([("a", 1)], "document_id string, seq int"), t, order_col="seq")
    last = K.versions(spark, t)[-1]
    K._add_manifest(spark, t, last + 1, K._read_manifest(spark, t, last))
    with pytest.raises(RuntimeError):
        K._add_manifest(spark, t, last + 1, {})
    assert K.read_table(spark, t).count() == 1 and not [x for x in os.listdir(t) if x.startswith("._manifest") and not x.endswith(".crc")]
