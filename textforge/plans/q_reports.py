"""Run-log style reports over the events table."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textforge.plans.catalog import register, table

BUCKETS = 4096  # of a group's range of values


@register(
    "event_rate_5min",
    sql="""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS n_events
FROM events GROUP BY ALL""",
)
def event_rate_5min(spark, sf_dir):
    e = table(spark, sf_dir, "events", spread_rows=False)
    g = e.groupBy(F.window("ts", "5 minutes"), "event_type").agg(F.count("*").alias("n_events"))
    return g.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "event_type", "n_events")


@register(
    "error_rate_5min",
    sql="""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n_events,
  count_if(event_type = 'error') AS n_errors,
  round(count_if(event_type = 'error') / count(*), 6) AS error_rate
FROM events GROUP BY ALL""",
)
def error_rate_5min(spark, sf_dir):
    e = table(spark, sf_dir, "events", spread_rows=False)
    g = e.groupBy(F.window("ts", "5 minutes")).agg(
        F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_errors"))
    return g.select(F.col("window.start").alias("window_start"), "n_events", "n_errors",
                    F.round(F.col("n_errors") / F.col("n_events"), 6).alias("error_rate"))


@register(
    "value_p95_by_type",
    sql="""SELECT event_type, count(*) AS n_events, round(quantile_cont(value, 0.95), 6) AS p95_value,
  round(quantile_cont(value, 0.5), 6) AS p50_value FROM events GROUP BY event_type""",
)
def value_p95_by_type(spark, sf_dir):
    """R11, exact: counts by range bucket say which bucket holds a rank; only that bucket's values are ordered.

    A group's values are never held together; of equal values one row with their number is kept."""
    e = table(spark, sf_dir, "events", spread_rows=False).select("event_type", "value")
    stats = e.groupBy("event_type").agg(F.count("*").alias("n_events"), F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    width = F.greatest(F.col("high") - F.col("low"), F.lit(1e-300)) / BUCKETS
    bucket = F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(BUCKETS - 1))
    counts = (e.filter("value is not null").groupBy("event_type", "value").agg(F.count("*").alias("c"))
              .join(stats, "event_type").withColumn("bucket", bucket))
    per = counts.groupBy("event_type", "bucket").agg(F.sum("c").alias("c"))
    # at most BUCKETS rows in a window
    per = per.withColumn("upto", F.sum("c").over(W.partitionBy("event_type").orderBy("bucket"))).withColumn("before", F.col("upto") - F.col("c")).drop("c")
    ranks = stats.select("event_type", "n", F.explode(F.array(F.lit(0.95), F.lit(0.5))).alias("q")).withColumn("at", F.col("q") * (F.col("n") - 1))
    ranks = ranks.select("event_type", "q", "at", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).distinct()
    held = per.join(ranks, "event_type").filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))
    inside = counts.select("event_type", "bucket", "value", "c").join(held, ["event_type", "bucket"])
    seen = F.sum("c").over(W.partitionBy("event_type", "q", "rank").orderBy("value"))
    inside = inside.withColumn("end", F.col("before") + seen).filter((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("c")))
    # between the two neighbouring ranks, as a continuous quantile has it
    value = inside.groupBy("event_type", "q").agg((F.min("value") + (F.max("value") - F.min("value")) * (F.max("at") - F.floor(F.max("at")))).alias("v"))
    wide = value.groupBy("event_type").agg(*[F.round(F.max(F.when(F.col("q") == q, F.col("v"))), 6).alias(name) for q, name in ((0.95, "p95_value"), (0.5, "p50_value"))])
    return stats.select("event_type", "n_events").join(wide, "event_type", "left")


@register(
    "value_sum_by_type",
    sql="""SELECT event_type, count(*) AS n_events, CAST(round(sum(value) * 100) AS BIGINT) AS total_value_cents,
  count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type""",
)
def value_sum_by_type(spark, sf_dir):
    e = table(spark, sf_dir, "events", spread_rows=False)
    return e.groupBy("event_type").agg(
        F.count("*").alias("n_events"),
        F.round(F.sum("value") * 100).cast("bigint").alias("total_value_cents"),
        F.count_distinct("user_id").alias("n_users"),
    )
