"""The full preprocess job, record in -> record out, as one Spark plan.

    raw text --(E3: entity words, for typo protection)
      -> C1..C9 (+C3) -> T1..T7 (dictionary join) -> C2 -> cleaned_text
      -> E1/E2 entities -> M1..M8 metadata -> E9..E11 counts, language
      -> E4..E7 temporal_metadata -> output schema (21 fields)

Model-like inputs are tables: ``dictionary`` (word, freq), ``gazetteer``
(key, type, n_tokens), ``profiles`` (lang, gram, rank). Any of them may be
None, which drops that step from the plan. Joins inside the plan are keyed on
``key_col``, which must be unique per input row (the ingest line key);
``document_id`` may repeat in a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.config import PipelineConfig
from textforge.functions import clean as C
from textforge.functions.dates import normalize_date, reference_date
from textforge.functions.metrics import reading_time, supplied_or, word_count
from textforge.operators import metadata as M
from textforge.operators.entities import entity_words, first_date_text, tag_entities
from textforge.operators.language import detect_language
from textforge.operators.typo import correct_typos
from textforge.session import materialize
from textforge.sources.jsonl import once

VERSION = "1.0"
OUTPUT_COLUMNS = (
    "document_id", "version", "original_text", "cleaned_text", "cleaned_title", "cleaned_excerpt", "cleaned_author",
    "cleaned_publication_date", "cleaned_revision_date", "cleaned_source_url", "cleaned_categories", "cleaned_tags",
    "cleaned_media_asset_urls", "cleaned_geographical_data", "cleaned_embargo_date", "cleaned_sentiment",
    "cleaned_word_count", "cleaned_publisher", "temporal_metadata", "entities", "cleaned_additional_metadata",
)


def preprocess(articles: DataFrame, cfg: PipelineConfig | None = None, run_date: str = "1970-01-01",
               dictionary: DataFrame | None = None, gazetteer: DataFrame | None = None,
               profiles: DataFrame | None = None, key_col: str = "document_id",
               keep: tuple[str, ...] = (), override: dict | None = None) -> DataFrame:
    """``override``: cleaning settings of this call; they hold for the text, not for the metadata."""
    cfg = cfg or PipelineConfig()
    cc, meta_cfg = cfg.cleaning.merge(override), cfg.cleaning
    df, clean = articles, M.in_row(meta_cfg)
    # first, while nothing else hangs on the plan: the branch over metadata strings reads the articles only
    if meta_cfg.fix_encoding or (meta_cfg.enable_typo_correction and dictionary is not None):
        df, clean = M.relational(df, key_col, meta_cfg, dictionary)

    # E3 -> T7: entity words of the raw text protect names from typo correction.
    ew_col = None
    typos = cc.enable_typo_correction and dictionary is not None
    if typos and cc.typo_use_ner and gazetteer is not None and cfg.entity_recognition:
        raw = df.select(F.col(key_col).alias("_k"), C.normalize_whitespace("text").alias("_raw"))
        raw = tag_entities(raw, "_k", "_raw", gazetteer, types=None, out_col="_raw_ents")
        raw = raw.select("_k", entity_words(F.col("_raw_ents")).alias("_entity_words"))
        df = df.join(raw, df[key_col] == raw["_k"], "left").drop("_k")
        ew_col = "_entity_words"

    df = df.withColumn("_pre", C.clean_text_before_typos("text", cc))
    if typos:
        if cfg.materialize:
            df = materialize(df, "pre-typo")
        df = correct_typos(df, key_col, "_pre", dictionary, cc, ew_col)
    df = df.withColumn("cleaned_text", C.clean_text_after_typos("_pre", cc)).drop("_pre")
    if ew_col:
        df = df.drop(ew_col)

    # Entity tagging reads its input in two branches (n-grams, join-back):
    # write the cleaned text once so typo correction is not re-derived.
    if cfg.materialize and cfg.entity_recognition and (typos or cc.fix_encoding):
        df = materialize(df, "cleaned-text")
    if cfg.entity_recognition:
        df = tag_entities(df, key_col, "cleaned_text", gazetteer, types=cfg.entity_types, out_col="entities")
        df = df.withColumn("entities", once(F.col("entities")))
    else:
        df = df.withColumn("entities", F.array().cast("array<struct<text:string,type:string,start_char:int,end_char:int>>"))

    # Word count: the supplied value wins; else whitespace tokens of the cleaned text.
    wc = supplied_or(F.col("word_count"), word_count(F.col("cleaned_text"), whitespace_normalized=cc.normalize_whitespace))
    df = df.withColumn("cleaned_word_count", wc.cast("int"))

    am = F.col("additional_metadata")
    orig_rt = F.try_variant_get(am, "$.reading_time", "variant")
    orig_lang = F.try_variant_get(am, "$.language", "variant")
    has_rt = orig_rt.isNotNull() & (F.schema_of_variant(orig_rt) != "VOID")
    has_lang = orig_lang.isNotNull() & (F.schema_of_variant(orig_lang) != "VOID")

    if profiles is not None:
        # in the row: the entities and the text before it are computed once, as input of the Arrow function
        df = df.withColumn("_undetected", F.when(~has_lang, F.col("cleaned_text")))
        df = detect_language(df, "_undetected", profiles, out_col="_detected", min_chars=cfg.language_min_chars)
    else:
        df = df.withColumn("_detected", F.lit(None).cast("string"))

    rt = F.when(has_rt, M.clean_metadata_value(orig_rt, clean, "additional_metadata", "reading_time")).otherwise(
        reading_time(F.col("cleaned_word_count"), cfg.words_per_minute).cast("variant"))
    lang = F.when(has_lang, M.clean_metadata_value(orig_lang, clean, "additional_metadata", "language")).otherwise(F.col("_detected").cast("variant"))
    meta = M.merge_computed(M.clean_additional_metadata(am, clean, "additional_metadata"),
                            {"cleaned_reading_time": rt, "cleaned_language": lang})

    date_text = first_date_text(F.col("entities"), F.col("cleaned_text"))
    temporal = normalize_date(date_text, reference_date(F.col("publication_date"), run_date))

    out = df.select(
        *keep,
        "document_id",
        F.lit(VERSION).alias("version"),
        F.col("text").alias("original_text"),
        "cleaned_text",
        M.clean_string(F.col("title"), clean, "title").alias("cleaned_title"),
        M.clean_string(F.col("excerpt"), clean, "excerpt").alias("cleaned_excerpt"),
        M.clean_string(F.col("author"), clean, "author").alias("cleaned_author"),
        F.col("publication_date").alias("cleaned_publication_date"),
        F.col("revision_date").alias("cleaned_revision_date"),
        F.col("source_url").alias("cleaned_source_url"),
        M.clean_string_list(F.col("categories"), clean, "categories").alias("cleaned_categories"),
        M.clean_string_list(F.col("tags"), clean, "tags").alias("cleaned_tags"),
        F.col("media_asset_urls").alias("cleaned_media_asset_urls"),
        M.clean_variant_object(F.col("geographical_data"), clean, "geographical_data").alias("cleaned_geographical_data"),
        F.col("embargo_date").alias("cleaned_embargo_date"),
        M.clean_string(F.col("sentiment"), clean, "sentiment").alias("cleaned_sentiment"),
        "cleaned_word_count",
        M.clean_string(F.col("publisher"), clean, "publisher").alias("cleaned_publisher"),
        temporal.alias("temporal_metadata"),
        "entities",
        F.to_variant_object(meta).alias("cleaned_additional_metadata"),
    )
    return out
