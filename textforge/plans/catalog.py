"""Registered queries: one Spark plan per operator, each with its SQL twin.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.
Inputs are the driver tables or columns Spark derives from them. Derived
test sentences are written once as SQL expressions valid in both engines and
used through ``F.expr`` on the Spark side, so both engines see identical input.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = (fn, sql)
        return fn

    return deco


# Text-heavy tables and the key used to spread them across cores.
SPREAD_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "lineitem": "l_orderkey",
               "orders": "o_orderkey", "events": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = True) -> DataFrame:
    from textforge.sources.tables import read_table

    key = SPREAD_KEYS.get(name)
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", key, spread_rows and key is not None)


def _load_all() -> None:
    # Importing the modules fills QUERIES.
    from textforge.plans import q_clean, q_enrich, q_entities, q_ingest, q_language, q_preprocess, q_reports, q_sinks, q_typo  # noqa: F401
