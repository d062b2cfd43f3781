"""Reading input tables with enough parallelism for per-row text work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Hash-repartition on ``key`` only when the scan gives fewer partitions than cores.

    Per-row regex work is CPU-bound; a scan of one large row group is a single
    task. On a cluster reading many files this is a no-op (the scan already has
    far more splits than cores); locally it spreads the rows once. Hash
    partitioning on the document key is deterministic (no sort for retries)
    and later joins/aggregations on that key reuse it.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def read_table(spark: SparkSession, path: str, key: str | None = None, spread_rows: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    return spread(df, key) if spread_rows else df
