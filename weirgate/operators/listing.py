"""Listings, access paths and short series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from weirgate import fixed_values as fv
from weirgate.functions.timeaxis import bucket_start, instant, shift


def newest_first(df: DataFrame, limit: int, at: str = "created_at", ties: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Top rows by recency: each task keeps ``limit`` rows, nothing is sorted globally."""
    return df.orderBy(F.col(at).desc(), *[F.col(t) for t in ties]).limit(limit)


def by_type(df: DataFrame, event_type: str) -> DataFrame:
    return df.filter(F.col("event_type") == event_type)


def by_user(df: DataFrame, user_id: str) -> DataFrame:
    return df.filter(F.col("user_id") == user_id)


def payload_contains(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Rows whose payload has every expected top-level key with the expected value."""
    fields = F.from_json("data", "map<string,string>")
    condition = F.lit(True)
    for key, value in expected.items():
        condition = condition & (F.element_at(fields, F.lit(key)) == value)
    return df.filter(condition)


def recent(df: DataFrame, as_of: Column, minutes: int = 15, at: str = "received_at") -> DataFrame:
    return df.filter((instant(F.col(at)) >= shift(as_of, -60 * minutes)) & (instant(F.col(at)) <= as_of))


def chart_points(df: DataFrame, latency: str, step: int, points: int = fv.CHART_POINTS, at: str = "received_at") -> DataFrame:
    """The last points of the throughput and latency chart."""
    series = df.groupBy(bucket_start(F.col(at), step).alias("point_at")).agg(
        F.count(F.lit(1)).alias("events"), F.avg(latency).alias("latency")
    )
    return series.orderBy(F.col("point_at").desc()).limit(points)


def day_over_day(df: DataFrame, keys: list[str], at: str = "received_at") -> DataFrame:
    """Daily counts on a gap-filled day grid with the change against the day before, in percent."""
    daily = df.groupBy(*keys, F.to_date(instant(F.col(at))).alias("day")).agg(F.count(F.lit(1)).alias("events"))
    line = W.partitionBy(*keys).orderBy("day")
    until = F.coalesce(F.date_sub(F.lead("day").over(line), 1), F.col("day"))
    filled = (
        daily.withColumn("_until", until)
        .select(*keys, F.explode(F.sequence("day", "_until")).alias("_day"), "day", "events")
        .select(*keys, F.col("_day").alias("day"), F.when(F.col("_day") == F.col("day"), F.col("events")).otherwise(F.lit(0)).alias("events"))
    )
    before = F.lag("events").over(line)
    return filled.withColumn(
        "change_percent", F.when(before > 0, (F.col("events") - before) * F.lit(100.0) / before)
    )
