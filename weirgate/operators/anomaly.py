"""Hourly counts that stand out from the day before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from weirgate.functions.timeaxis import instant


def anomalies(
    df: DataFrame,
    as_of: Column,
    history: int = 24,
    z: float = 3.0,
    min_history: int = 12,
    at: str = "received_at",
) -> DataFrame:
    """(event_type, hour, events, mean, deviation, score, anomalous) from the type's first hour to ``as_of``.

    Rows are counted per type and hour before anything is ordered; missing hours count as zero.
    """
    hourly = (
        df.filter("event_type IS NOT NULL")
        .groupBy("event_type", F.date_trunc("hour", instant(F.col(at))).alias("hour"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    line = W.partitionBy("event_type").orderBy("hour")
    hour = F.expr("INTERVAL 1 HOUR")
    following = F.coalesce(F.lead("hour").over(line), F.date_trunc("hour", as_of) + hour)
    filled = (
        hourly.withColumn("_last", F.greatest(following - hour, F.col("hour")))
        .select("event_type", F.explode(F.sequence("hour", "_last", hour)).alias("_hour"), "hour", "events")
        .select("event_type", F.col("_hour").alias("hour"), F.when(F.col("_hour") == F.col("hour"), F.col("events")).otherwise(F.lit(0)).alias("events"))
    )
    past = line.rowsBetween(-history, -1)
    scored = filled.withColumns(
        {
            "hours": F.count(F.lit(1)).over(past),
            "mean": F.avg("events").over(past),
            "deviation": F.stddev_pop("events").over(past),
        }
    ).withColumn("score", F.when(F.col("deviation") > 0, (F.col("events") - F.col("mean")) / F.col("deviation")))
    flag = F.coalesce((F.abs("score") > z) & (F.col("hours") >= min_history), F.lit(False))
    return scored.select("event_type", "hour", "events", "mean", "deviation", "score", flag.alias("anomalous"))
