"""K1-K8: sinks for processed articles and run reports.

All writers are distributed Spark writes (no driver-side row loops). A keyed table is a set of hash buckets by extendible hashing: a
bucket is named by the leading bits of its keys' hashes and splits when its files pass ``max_bytes``. An upsert writes only
the batch, as a delta of the buckets it touches; a reader merges a bucket's deltas by version. A bucket is written anew when its
deltas pass a quarter of it or grow many. So a batch of a hundredth of the table writes a hundredth of it.

A numbered manifest names the folders of every bucket. Manifests are written under another name, appear at once under their own,
are never changed, and only one job can add a number; the highest counts. A job that stops anywhere leaves the table as it was, a
reader sees one version, and repeating a batch changes nothing but ``updated_at``. Rows without a key are one key.
"""

from __future__ import annotations

import json
import math
import uuid
from typing import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.plans.preprocess import OUTPUT_COLUMNS
from textforge.session import materialize

BULK_SIZE = 500  # documents per bulk request (K5)


# ---------------------------------------------------------------- K1 / K2
def envelope(processed: DataFrame) -> DataFrame:
    """``{document_id, version, processed_data{...}}`` per processed record."""
    data = F.struct(*[F.col(c) for c in OUTPUT_COLUMNS])
    return processed.select("document_id", "version", data.alias("processed_data"))


def write_results_jsonl(processed: DataFrame, path: str) -> None:
    """K1: result file(s), overwrite, nulls kept."""
    envelope(processed).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_daily_jsonl(processed: DataFrame, folder: str, run_date: str) -> None:
    """K2: append into ``ingest_date=YYYY-MM-DD`` partitions of ``folder``."""
    (processed.select(*OUTPUT_COLUMNS).withColumn("ingest_date", F.lit(run_date))
     .write.mode("append").option("ignoreNullFields", "false").partitionBy("ingest_date").json(folder))


# ---------------------------------------------------------------- K4
def to_sql_row(processed: DataFrame) -> DataFrame:
    """K4: lists/maps/entities -> JSON text, URLs -> string, bad temporal date -> null."""
    cols = []
    for c in OUTPUT_COLUMNS:
        if c in ("cleaned_categories", "cleaned_tags", "cleaned_media_asset_urls", "entities",
                 "cleaned_geographical_data", "cleaned_additional_metadata"):
            cols.append(F.to_json(F.col(c)).alias(c))
        elif c == "temporal_metadata":
            cols.append(F.try_to_date(F.col(c), "yyyy-MM-dd").alias(c))
        else:
            cols.append(F.col(c))
    return processed.select(*cols)


# ---------------------------------------------------------------- K3
def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


MANIFEST = "_manifest-"
KEEP_VERSIONS = 2  # a reader of the version before may still be at work


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def _read_manifest(spark: SparkSession, table_path: str, number: int) -> dict:
    fs, p = _fs(spark, f"{table_path}/{MANIFEST}{number:012d}.json")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def versions(spark: SparkSession, table_path: str) -> list[int]:
    """Numbers of the complete manifests, in order."""
    names = [n for n in _children(spark, table_path) if n.startswith(MANIFEST) and n.endswith(".json")]
    found = sorted(int(n[len(MANIFEST):-len(".json")]) for n in names)
    if not found and "data" in _children(spark, table_path):
        raise ValueError(f"{table_path} holds data but no manifest: it is no table, or its manifests were removed")
    return found


def _add_manifest(spark: SparkSession, table_path: str, number: int, manifest: dict) -> None:
    """Adds a version; fails if it is there. Where a rename would replace a file (local and mounted folders) a link is made, which
    never does."""
    fs, p = _fs(spark, f"{table_path}/.{MANIFEST}{uuid.uuid4().hex}")
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(manifest).encode("utf-8")))
    finally:
        out.close()
    _, final = _fs(spark, f"{table_path}/{MANIFEST}{number:012d}.json")
    if fs.getUri().getScheme() == "file":
        local = lambda x: spark._jvm.java.io.File(x.toUri().getPath()).toPath()
        try:
            spark._jvm.java.nio.file.Files.createLink(local(final), local(p))
            done = True
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            done = False
        fs.delete(p, False)
    else:
        done = not fs.exists(final) and fs.rename(p, final)
    if not done:
        raise RuntimeError(f"version {number} of {table_path} was written by another job; repeat the batch")


def _clean_up(spark: SparkSession, table_path: str) -> None:
    """Removes versions, and bucket folders that none of the last versions uses."""
    numbers = versions(spark, table_path)
    used = {path for n in numbers[-KEEP_VERSIONS:] for paths in _read_manifest(spark, table_path, n)["paths"].values() for path in paths}
    folders = {path.split("/")[1] for path in used}
    gone = [f"{MANIFEST}{n:012d}.json" for n in numbers[:-KEEP_VERSIONS]]
    for name in _children(spark, f"{table_path}/data"):
        if name not in folders:
            gone.append(f"data/{name}")
        else:
            gone += [f"data/{name}/{x}" for x in _children(spark, f"{table_path}/data/{name}") if "=" in x and f"data/{name}/{x}" not in used]
    for x in gone:
        fs, p = _fs(spark, f"{table_path}/{x}")
        fs.delete(p, True)


MAX_BUCKET_BYTES = 256 << 20
MOST_DELTAS = 8
META = ("_version", "_hash")


def _read_paths(spark: SparkSession, table_path: str, paths: Iterable[str]) -> DataFrame | None:
    found = [f"{table_path}/{x}" for x in paths]
    return spark.read.option("mergeSchema", "true").parquet(*found) if found else None


def _merged(rows: DataFrame, key: str) -> DataFrame:
    """The latest version of each key, with the first one's ``created_at``. Found on small rows; the wide ones follow."""
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max("_version").alias("_last"), F.min_by("created_at", "_version").alias("_created"))
    found = rows.join(last, rows[key].eqNullSafe(last["_key"]) & (rows["_version"] == last["_last"]))
    return found.withColumn("created_at", F.col("_created")).drop("_key", "_last", "_created")


def read_table(spark: SparkSession, table_path: str) -> DataFrame | None:
    numbers = versions(spark, table_path)
    if not numbers:
        return None
    manifest = _read_manifest(spark, table_path, numbers[-1])
    whole = _read_paths(spark, table_path, [p[0] for p in manifest["paths"].values() if len(p) == 1])
    several = _read_paths(spark, table_path, [x for p in manifest["paths"].values() if len(p) > 1 for x in p])
    parts = ([whole] if whole is not None else []) + ([_merged(several, manifest["key"])] if several is not None else [])
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return rows.drop(*META)


def _bucketed(rows: DataFrame, leaves: list[str]) -> DataFrame:
    """rows with ``_bucket``: the leaf whose bits begin their hash."""
    bits = F.lpad(F.bin("_hash"), 64, "0")
    depths = sorted({len(x) for x in leaves})
    if len(depths) == 1:
        return rows.withColumn("_bucket", F.substr(bits, F.lit(1), F.lit(depths[0])))
    deepest = rows.sparkSession.createDataFrame([(x,) for x in leaves], "_bucket string")
    tried = rows.withColumn("_bucket", F.explode(F.array(*[F.substr(bits, F.lit(1), F.lit(d)) for d in depths])))
    return tried.join(deepest, "_bucket", "left_semi")  # exactly one is a leaf


def _write_buckets(rows: DataFrame, table_path: str, max_bytes: int, size: int, buckets: int) -> dict[str, tuple[str, int]]:
    """Writes rows with ``_bucket``; (folder, bytes) of each bucket. Large buckets are dealt over several tasks by hash."""
    spark, folder = rows.sparkSession, f"data/{uuid.uuid4().hex}"
    ways = max(1, -(-size // (max_bytes * max(1, buckets))))
    rows.repartition(F.col("_bucket"), F.pmod("_hash", F.lit(ways))).write.partitionBy("_bucket").parquet(f"{table_path}/{folder}")
    out = {}
    for x in _children(spark, f"{table_path}/{folder}"):
        if x.startswith("_bucket="):
            fs, p = _fs(spark, f"{table_path}/{folder}/{x}")
            out[x.partition("=")[2]] = (f"{folder}/{x}", fs.getContentSummary(p).getLength())
    return out


def _halved(leaf: str, size: int, max_bytes: int) -> list[str]:
    """A leaf, or the leaves that it splits into so that each has about ``max_bytes`` at most."""
    more = math.ceil(math.log2(size / max_bytes)) if size > max_bytes else 0
    return [leaf + (format(i, f"0{more}b") if more else "") for i in range(1 << more)]


def upsert(spark: SparkSession, batch: DataFrame, table_path: str, key: str = "document_id", *, order_col: str,
           now: str | None = None, keep_order: bool = True, buckets: int = 64, max_bytes: int = MAX_BUCKET_BYTES) -> DataFrame:
    """K3: keyed upsert, last write wins; ``created_at`` set on insert, kept on update.

    ``order_col`` orders the versions of one key inside the batch (the latest wins; of equal ones, the later row);
    ``keep_order=False`` leaves it out of the table. ``buckets`` (a power of two) holds for a new table."""
    ts = F.to_timestamp(F.lit(now)) if now else F.current_timestamp()
    numbers = versions(spark, table_path)
    if not numbers:
        depth = max(0, (buckets - 1).bit_length())
        _add_manifest(spark, table_path, 0, {"key": key, "leaves": [format(i, f"0{depth}b") if depth else "" for i in range(1 << depth)], "paths": {}, "bytes": {}})
        numbers = [0]
    number, manifest = numbers[-1] + 1, _read_manifest(spark, table_path, numbers[-1])
    if manifest["key"] != key:
        raise ValueError(f"{table_path} is keyed by {manifest['key']}, not {key}")
    hashed = batch.drop("created_at", "updated_at", *META).withColumn("_row", F.monotonically_increasing_id()).withColumn("_hash", F.xxhash64(F.col(key).cast("string")))
    rows = materialize(hashed, "upsert-batch")
    # the latest version is found on small rows; the wide ones follow by row number
    latest = rows.groupBy(key).agg(F.max(F.struct(order_col, "_row")).alias("_v")).select(F.col("_v._row").alias("_row"))
    latest = rows.join(latest, "_row").drop("_row")
    if not keep_order:
        latest = latest.drop(order_col)
    latest = latest.withColumn("created_at", ts).withColumn("updated_at", ts).withColumn("_version", F.lit(number).cast("long"))
    size = sum(_fs(spark, f)[0].getContentSummary(_fs(spark, f)[1]).getLength() for f in {x.rpartition("/")[0] for x in rows.inputFiles()})
    delta = _write_buckets(_bucketed(latest, manifest["leaves"]), table_path, max_bytes, size, len(manifest["leaves"]))
    paths, sizes = {b: list(p) for b, p in manifest["paths"].items()}, {b: list(n) for b, n in manifest["bytes"].items()}
    for b, (path, n) in delta.items():
        paths.setdefault(b, []).append(path)
        sizes.setdefault(b, []).append(n)
    leaves = manifest["leaves"]
    due = [b for b in delta if len(paths[b]) > 1 and (sum(sizes[b][1:]) * 4 > sizes[b][0] or len(paths[b]) > MOST_DELTAS) or sum(sizes[b]) > max_bytes]
    if due:
        split = {b: _halved(b, sum(sizes[b]), max_bytes) for b in due}
        leaves = sorted(x for b in leaves for x in split.get(b, [b]))
        old = _read_paths(spark, table_path, [x for b in due for x in paths[b]])
        new = _write_buckets(_bucketed(_merged(old, key), leaves), table_path, max_bytes, sum(sum(sizes[b]) for b in due), sum(map(len, split.values())))
        for b in due:
            del paths[b], sizes[b]
        paths |= {b: [path] for b, (path, _) in new.items()}
        sizes |= {b: [n] for b, (_, n) in new.items()}
    _add_manifest(spark, table_path, number, {"key": key, "leaves": leaves, "paths": paths, "bytes": sizes})
    _clean_up(spark, table_path)
    return read_table(spark, table_path)


# ---------------------------------------------------------------- K5
def write_index_bulk(processed: DataFrame, folder: str, index: str = "news_articles",
                     fmt: str | None = None, options: dict | None = None) -> DataFrame:
    """K5: documents keyed by ``_id = document_id``; returns (bulk, success, errors).

    With a connector ``fmt`` (e.g. an Elasticsearch Spark format) the rows are written through it with the id mapping; it
    fails the job on errors. Otherwise bulk-API NDJSON files are written, each one bulk of at most ``BULK_SIZE`` documents
    (action line + source line); the counts are read from these files: an action without its source is an error.
    """
    src = processed.select(*OUTPUT_COLUMNS)
    if fmt:
        (src.write.format(fmt).options(**{"es.mapping.id": "document_id", **(options or {})})
         .mode("append").save(index))
        return src.agg(F.lit(None).cast("string").alias("bulk"), F.count("*").alias("success"), F.lit(0).cast("bigint").alias("errors"))
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col("document_id").alias("_id")).alias("index")))
    body = F.to_json(F.struct(*[F.col(c) for c in OUTPUT_COLUMNS]), {"ignoreNullFields": "false"})
    lines = src.select(F.concat_ws("\n", action, body).alias("value"))
    lines.write.mode("overwrite").option("maxRecordsPerFile", BULK_SIZE).text(folder)
    is_action = F.col("value").startswith('{"index":{"_index":')
    back = processed.sparkSession.read.text(folder).select(F.col("_metadata.file_name").alias("bulk"), "value")
    return back.groupBy("bulk").agg(F.count_if(~is_action).alias("success"), (F.count_if(is_action) - F.count_if(~is_action)).alias("errors"))


# ---------------------------------------------------------------- K6 / K7
SinkFn = Callable[[DataFrame], None]
_SINKS: dict[str, Callable[..., SinkFn]] = {}


def register_sink(name: str, factory: Callable[..., SinkFn]) -> None:
    """K7: add a sink; ``factory(**options) -> fn(processed_df)``."""
    _SINKS[name] = factory


register_sink("jsonl", lambda path, **_: (lambda df: write_results_jsonl(df, path)))
register_sink("daily_jsonl", lambda folder, run_date, **_: (lambda df: write_daily_jsonl(df, folder, run_date)))
register_sink("table", lambda table_path, order_col, **_: (
    lambda df: upsert(df.sparkSession, df, table_path, order_col=order_col)))
register_sink("index", lambda folder, **_: (lambda df: write_index_bulk(df, folder)))


def select_backends(requested: Iterable[str] | None, enabled: Iterable[str]) -> list[str]:
    """K6: requested and enabled sinks (unknown names skipped), all enabled ones by default; ``jsonl`` if none is left."""
    enabled = [e for e in enabled if e in _SINKS]
    return [r for r in (requested or enabled) if r in enabled] or ["jsonl"]


def fan_out(processed: DataFrame, backends: dict[str, dict], requested: Iterable[str] | None = None,
            default_path: str | None = None, written: bool = False) -> list[str]:
    """K6: compute once, write to every selected sink; returns their names.

    ``default_path``: where results go when none of the requested sinks is enabled and ``jsonl`` has no options. ``written``:
    ``processed`` is a written table already (``materialize``), and no second copy of it is made."""
    names = select_backends(requested, backends)
    options = {**({"jsonl": {"path": default_path}} if default_path else {}), **backends}
    p = processed if written else materialize(processed, "fan-out", "zstd")
    for name in names:
        _SINKS[name](**options[name])(p)
    return names


# ---------------------------------------------------------------- K8
def write_error_report(summary: DataFrame, quarantine: DataFrame, folder: str) -> bool:
    """K8: ``summary`` (one row) and all ``errors`` under one report folder, if the summary counts errors; whether it did.

    Errors are written by every task in parallel, not gathered into one file."""
    row = summary.first()
    if not row or not row["total_errors"]:
        return False
    summary.coalesce(1).write.mode("overwrite").json(f"{folder}/summary")
    quarantine.write.mode("overwrite").json(f"{folder}/errors")
    return True
