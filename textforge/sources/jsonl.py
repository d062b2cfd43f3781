"""JSONL ingestion.

``read_lines`` gives ``(file, line_number, value)`` with 1-based line numbers
per file and no global sort: rows keep their split; one small aggregate per
(file, split) gives each split's first line number by a prefix sum.
``parse_lines`` classifies each line as blank / parsed object / decode error,
sending only natively-unparseable lines through the repair helper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textforge.functions.jsonrepair import extract_fields, fix_unicode, quote_repair
from textforge.functions.urls import strip_ws

# Batch admission limits (records per batch, bytes per file).
MAX_BATCH_RECORDS = 1000
MIN_BATCH_RECORDS = 1
MAX_FILE_BYTES = 50 * 1024 * 1024


def read_lines(spark: SparkSession, path: str | list[str], by_folder: bool = False) -> DataFrame:
    """JSONL/text files -> (file, line_number, value).

    ``by_folder``: the part files of a folder, in the order of their names, are one file, named by the folder."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("mid"),
        "value",
    )
    if by_folder:
        raw = raw.withColumn("part_file", F.col("file")).withColumn("file", F.regexp_replace("file", "/[^/]*$", ""))
    return number_lines(raw)


def number_lines(raw: DataFrame) -> DataFrame:
    """Line numbers from (file, block_start, mid), or (file, part_file, block_start, mid): one row per split is aggregated,
    prefix-summed per file and joined back; the join strategy is left to the planner."""
    place = [c for c in ("part_file", "block_start") if c in raw.columns]
    splits = raw.groupBy("file", *place).agg(F.count("*").alias("n"), F.min("mid").alias("first_mid"))
    w = Window.partitionBy("file").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", *place, "first_mid", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("offset"))
    j = raw.join(offsets, ["file", *place])
    return j.select("file", (F.col("offset") + F.col("mid") - F.col("first_mid") + 1).alias("line_number"), "value")


def once(c: Column) -> Column:
    """``c`` as a column that Catalyst neither copies into later expressions nor evaluates again for a pushed filter."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def parse_lines(lines: DataFrame, value_col: str = "value", repair: bool = True) -> DataFrame:
    """Adds ``stripped``, ``is_blank``, ``parsed`` (variant object or null),
    ``json_error`` (string or null) and ``repair_strategy`` (1-5 or null)."""
    def strict(c: Column) -> Column:
        """The one value of a line, else null: trailing text and two values fail."""
        w = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
        return F.when(F.try_variant_get(w, "$[1]", "variant").isNull(), F.try_variant_get(w, "$[0]", "variant"))

    df = lines.withColumn("stripped", strip_ws(F.col(value_col))).withColumn("is_blank", F.col("stripped") == "")
    df = df.withColumn("_1", once(strict(F.col("stripped"))))
    tries = [F.col("_1")]
    err = F.lit("Invalid JSON")
    if repair:
        df = df.withColumn("_bad", F.when(~F.col("is_blank") & F.col("_1").isNull(), F.col("stripped")))
        df = df.withColumn("_fixed", once(fix_unicode(F.col("_bad")))).withColumn("_rep", quote_repair(F.col("_bad"), F.col("_fixed")))
        df = df.withColumn("_got", extract_fields(F.col("_bad")))
        full = F.col("_got.document_id").isNotNull() & F.col("_got.text").isNotNull()
        tries += [strict(F.col("_rep.escaped")), strict(F.col("_fixed")), strict(F.col("_rep.escaped_fixed")),
                  F.when(full, F.parse_json(F.to_json("_got")))]
        err = F.concat(F.lit("All parsing failed. "), F.coalesce("_rep.error", err))
    # the first try that parses, with its number; later ones are not evaluated
    def numbered(value: Column, number: int) -> Column:
        return F.get(F.transform(F.array(value), lambda x: F.when(x.isNotNull(), F.struct(x.alias("value"), F.lit(number).alias("strategy")))), 0)

    df = df.withColumn("_best", once(F.coalesce(*[numbered(t, i) for i, t in enumerate(tries, 1)])))
    df = df.withColumn("_parsed", F.col("_best.value"))
    strat = F.col("_best.strategy")
    err = F.when(F.col("_best").isNull() & ~F.col("is_blank"), err)
    kind = F.schema_of_variant(F.col("_parsed"))
    is_obj = kind.startswith("OBJECT")
    df = df.select(
        *[c for c in lines.columns],
        "stripped",
        "is_blank",
        F.when(~F.col("is_blank") & is_obj, F.col("_parsed")).alias("parsed"),
        F.when(F.col("is_blank"), F.lit(None).cast("string"))
        .when(err.isNotNull(), err)
        .when(F.col("_parsed").isNull(), F.lit("Invalid JSON"))
        .when(~is_obj, F.concat(F.lit("Expected a JSON object, got "), kind))
        .alias("json_error"),
        F.when(~F.col("is_blank") & is_obj, strat).alias("repair_strategy"),
    )
    return df


def chunk_id(line_number: Column, size: int) -> Column:
    """Batches of ``size`` consecutive lines, no single-partition window."""
    return F.floor((line_number - 1) / F.lit(size)).cast("bigint")


def admission(lines: DataFrame, batch_size: int = MAX_BATCH_RECORDS, max_records: int = MAX_BATCH_RECORDS) -> DataFrame:
    """Per (file, batch) record counts against the limits."""
    nonblank = lines.filter(strip_ws(F.col("value")) != "")
    per_batch = nonblank.groupBy("file", chunk_id(F.col("line_number"), batch_size).alias("batch_id")).agg(
        F.count("*").alias("n_records"), F.sum(F.length(F.col("value")) + 1).alias("n_chars")
    )
    return per_batch.withColumn(
        "accepted", (F.col("n_records") >= MIN_BATCH_RECORDS) & (F.col("n_records") <= max_records)
    )


def file_admission(spark: SparkSession, path: str | list[str], max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Files over the byte limit are rejected; only file metadata is read
    (the binaryFile source prunes the unselected ``content`` column)."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"),
                                                              F.col("length").alias("file_size"))
    return files.withColumn("accepted", F.col("file_size") <= max_bytes)
