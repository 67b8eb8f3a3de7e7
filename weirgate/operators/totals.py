"""Totals, rates of success, rollups and freshness over an ``outcomes`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.timeaxis import instant, shift
from weirgate.operators.outcome import DUPLICATE, FAILED, PROCESSED


def _is(outcome: str) -> Column:
    return F.col("outcome") == outcome


def success_rate(processed: Column, received: Column) -> Column:
    """Percent, half up to two places; 100 when nothing was received."""
    return F.when(received == 0, F.lit(100.0)).otherwise(
        F.floor(processed * F.lit(10000.0) / received + F.lit(0.5)) / F.lit(100.0)
    )


def success_gauge(processed: Column, received: Column) -> Column:
    return F.when(received == 0, F.lit(100.0)).otherwise(processed * F.lit(100.0) / received)


def failed_share(failed: Column, received: Column) -> Column:
    return F.when(received == 0, F.lit(0.0)).otherwise(failed * F.lit(100.0) / received)


def totals(outcomes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return outcomes.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("total_received"),
        F.count_if(_is(PROCESSED)).alias("total_processed"),
        F.count_if(_is(FAILED)).alias("total_failed"),
        F.count_if(_is(DUPLICATE)).alias("total_duplicated"),
    )


def processed_by_type(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(_is(PROCESSED)).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def uptime_seconds(first: Column, last: Column) -> Column:
    return F.coalesce(F.timestamp_diff("SECOND", first, last), F.lit(0))


def counts_per_type(outcomes: DataFrame) -> DataFrame:
    """One row per event type; also the streaming aggregate behind the live snapshot."""
    at = instant(F.col("received_at"))
    return outcomes.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(_is(PROCESSED)).alias("processed"),
        F.count_if(_is(FAILED)).alias("failed"),
        F.count_if(_is(DUPLICATE)).alias("duplicated"),
        F.min(at).alias("first"),
        F.max(at).alias("last"),
    )


def snapshot_from_counts(per_type: DataFrame) -> DataFrame:
    """One row: totals, success rate, processed events by type, seconds covered."""
    entry = F.when(F.col("processed") > 0, F.struct("event_type", "processed"))
    summed = per_type.agg(
        F.coalesce(F.sum("received"), F.lit(0)).alias("total_received"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("total_processed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("total_failed"),
        F.coalesce(F.sum("duplicated"), F.lit(0)).alias("total_duplicated"),
        F.map_from_entries(F.collect_list(entry)).alias("events_by_type"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    return summed.select(
        "total_received", "total_processed", "total_failed", "total_duplicated",
        success_rate(F.col("total_processed"), F.col("total_received")).alias("success_rate"),
        "events_by_type",
        uptime_seconds(F.col("first"), F.col("last")).alias("uptime_seconds"),
    )


def stats_snapshot(outcomes: DataFrame) -> DataFrame:
    """Rows are first counted per type, so the map is built from one row per event type."""
    return snapshot_from_counts(counts_per_type(outcomes))


def hourly_metrics(outcomes: DataFrame) -> DataFrame:
    """Rows of the hourly metrics table. It stores no row without a type."""
    return (
        outcomes.filter("event_type IS NOT NULL")
        .groupBy(F.date_trunc("hour", "received_at").alias("hour_bucket"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("total_count"),
            F.count_if(_is(PROCESSED)).alias("success_count"),
            F.count_if(_is(FAILED)).alias("failure_count"),
        )
    )


def load_tally(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """What a load run reports: ok, failed, elapsed whole seconds (at least 1), events per second."""
    at = instant(F.col("received_at"))
    run = outcomes.groupBy(*keys).agg(
        F.count_if(~_is(FAILED)).alias("ok"),
        F.count_if(_is(FAILED)).alias("failed"),
        F.greatest(F.timestamp_diff("SECOND", F.min(at), F.max(at)), F.lit(1)).alias("elapsed_seconds"),
    )
    return run.withColumn("events_per_second", F.expr("(ok + failed) div elapsed_seconds"))


def freshness(outcomes: DataFrame, as_of: Column, within_seconds: int) -> DataFrame:
    """Per topic: is its newest row recent enough?"""
    newest = outcomes.filter("topic IS NOT NULL").groupBy("topic").agg(
        F.max(instant(F.col("received_at"))).alias("last_seen"), F.count(F.lit(1)).alias("events")
    )
    fresh = F.col("last_seen") >= shift(as_of, -within_seconds)
    return newest.withColumn("status", F.when(fresh, F.lit("UP")).otherwise(F.lit("DOWN")))


def overall_health(per_topic: DataFrame) -> DataFrame:
    up = F.coalesce(F.bool_and(F.col("status") == "UP"), F.lit(False))
    return per_topic.agg(
        F.when(up, F.lit("UP")).otherwise(F.lit("DOWN")).alias("status"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
    )


def accepted_count(validated: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return validated.groupBy(*(keys or [])).agg(F.count_if(F.size("errors") == 0).alias("processed_events"))


def series_sum(samples: DataFrame, series: list[str], at: str, value: str) -> DataFrame:
    """Sum across all series of their latest values."""
    latest = samples.groupBy(*series).agg(F.max_by(value, at).alias(value))
    return latest.agg(F.sum(value).alias("total"))


def last_non_null(df: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.max_by(value, at).alias("last_value"), F.max(at).alias("last_at")
    )
