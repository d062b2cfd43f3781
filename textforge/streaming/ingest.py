"""Asynchronous ingest as a Structured Streaming job.

A file-source stream of JSONL lines (``maxFilesPerTrigger`` /
``maxBytesPerTrigger`` play the role of the reference's rate limit) is
processed per micro-batch with ``foreachBatch``: line numbering, repair,
validation, the full preprocess plan and a keyed upsert into a snapshot table.
Delivery is at-least-once; the upsert is idempotent by key and every row
carries the micro-batch id, so a replayed batch rewrites the same keys.
Quarantined lines are appended per batch id (overwritten on replay).

``redelivery_window`` guards against files that are delivered again, under any
name: the stream is then one of files, whose content digests are kept as state
for that long after they came (watermark on the time of ingest, so a file's own
age does not matter but to Spark's file source, which by its option maxFileAge
passes over files a week older than the newest). A file whose content is known is left out before its lines are
read; a trigger that brings nothing new writes nothing. A file in a folder that the machines have mounted is digested piece by piece, so its
size is no matter of memory; in another store Spark reads it as one value, of 2 GB at most.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge._ship import by_value
from textforge.config import PipelineConfig
from textforge.operators.validate import ARTICLE_FIELDS
from textforge.plans import ingest as I
from textforge.plans.preprocess import preprocess
from textforge.session import materialize
from textforge.sinks.writers import upsert
from textforge.sources.jsonl import number_lines


by_value(__name__)

PIECE = 1 << 20  # bytes


def file_digest(path: str) -> str:
    """SHA-256 of a file of a mounted folder (``file:/...``), read piece by piece."""
    digest = hashlib.sha256()
    with open("/" + path.removeprefix("file:").lstrip("/"), "rb") as f:
        while piece := f.read(PIECE):
            digest.update(piece)
    return digest.hexdigest()


def content_digest(spark: SparkSession, input_dir: str) -> Column:
    """The digest of a row of the binary file source. Where Python reads the file, the source does not read its content."""
    path = spark._jvm.org.apache.hadoop.fs.Path(input_dir)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return F.sha2("content", 256)

    def digest(paths: pa.Array) -> pa.Array:
        return pa.array([file_digest(x) for x in paths.to_pylist()], pa.string())

    digest.__annotations__ = {"paths": pa.Array, "return": pa.Array}
    return F.arrow_udf(digest, T.StringType())(F.col("path"))


def read_line_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger)))
    return r.load(input_dir).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        "value",
    )


def read_new_files(spark: SparkSession, input_dir: str, redelivery_window: str, max_files_per_trigger: int | None = None,
                   max_bytes_per_trigger: int | None = None) -> DataFrame:
    """(file) of files whose content did not come within the window before."""
    r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger)))
    files = r.load(input_dir).select(F.col("path").alias("file"), content_digest(spark, input_dir).alias("digest"), "length", F.current_timestamp().alias("came"))
    return files.withWatermark("came", redelivery_window).dropDuplicatesWithinWatermark(["digest", "length"]).select("file")


def process_files(files: DataFrame, batch_id: int, *args) -> None:
    """The lines of a trigger's new files."""
    spark = files.sparkSession
    paths = [r.file for r in files.collect()]  # at most what a trigger may bring
    if paths:
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), "value")
        process_batch(lines, batch_id, *args)


def process_batch(batch: DataFrame, batch_id: int, table_path: str, quarantine_path: str,
                  cfg: PipelineConfig, run_date: str, dictionary=None, gazetteer=None, profiles=None) -> None:
    spark = batch.sparkSession
    raw = batch.withColumn("mid", F.monotonically_increasing_id())
    lines = number_lines(raw)
    classified = I.classify(lines).withColumn("batch_id", F.lit(batch_id))
    classified = classified.withColumn("line_key", F.concat_ws(":", F.col("file"), F.col("line_number")))
    # two sinks read it: repair and validation run once
    classified = materialize(classified, "stream-classified")
    q = I.quarantine(classified).withColumn("batch_id", F.lit(batch_id))
    q.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
    valid = I.valid_articles(classified).select("line_key", "file", "line_number", *ARTICLE_FIELDS)
    out = preprocess(valid, cfg, run_date, dictionary, gazetteer, profiles, key_col="line_key",
                     keep=("file", "line_number"))
    out = out.withColumn("batch_id", F.lit(batch_id))
    # Latest version of a key inside one batch: highest (file, line) wins.
    out = out.withColumn("_order", F.concat_ws(":", F.col("file"), F.lpad(F.col("line_number").cast("string"), 20, "0")))
    upsert(spark, out.drop("file", "line_number"), table_path, key="document_id", order_col="_order", keep_order=False)


def start_ingest_stream(spark: SparkSession, input_dir: str, table_path: str, quarantine_path: str,
                        checkpoint: str, cfg: PipelineConfig | None = None, run_date: str = "1970-01-01",
                        dictionary=None, gazetteer=None, profiles=None, max_files_per_trigger: int | None = None,
                        max_bytes_per_trigger: int | None = None, available_now: bool = True, redelivery_window: str | None = None):
    cfg = cfg or PipelineConfig()
    if redelivery_window:
        stream, process = read_new_files(spark, input_dir, redelivery_window, max_files_per_trigger, max_bytes_per_trigger), process_files
    else:
        stream, process = read_line_stream(spark, input_dir, max_files_per_trigger, max_bytes_per_trigger), process_batch
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, bid: process(df, bid, table_path, quarantine_path, cfg, run_date, dictionary, gazetteer, profiles))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
