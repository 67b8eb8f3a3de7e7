"""Tumbling, sliding and session windows over events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from weirgate.functions.timeaxis import micros
from weirgate.operators.nearest import slice_of
from weirgate.operators.rates import sliding_counts

HOUR = 3600


def tumbling(df: DataFrame, keys: list[str], size: int = HOUR, at: str = "received_at") -> DataFrame:
    return sliding_counts(df, keys, {"events": F.lit(1)}, size, size, at)


def sliding(df: DataFrame, keys: list[str], size: int = 300, slide: int = 60, at: str = "received_at") -> DataFrame:
    return sliding_counts(df, keys, {"events": F.lit(1)}, size, slide, at)


def sessions(df: DataFrame, key: str, gap: int = 1800, at: str = "received_at") -> DataFrame:
    """(key, session_start, session_end, events): a session ends ``gap`` after its last event.

    Two events in one cell of width ``gap`` always share a session. So each key is first cut to
    one row per cell (combined before the shuffle), and only cells are ordered per key.
    """
    width = gap * 1_000_000
    t = micros(F.col(at))
    cells = df.groupBy(key, slice_of(t, width).alias("_cell")).agg(
        F.min(t).alias("_from"), F.max(t).alias("_to"), F.count(F.lit(1)).alias("_n")
    )
    line = W.partitionBy(key).orderBy("_cell")
    fresh = F.coalesce(F.col("_from") - F.lag("_to").over(line) >= F.lit(width), F.lit(True))
    numbered = cells.withColumn("_fresh", fresh.cast("int")).withColumn("_no", F.sum("_fresh").over(line))
    return numbered.groupBy(key, "_no").agg(
        F.timestamp_micros(F.min("_from")).alias("session_start"),
        F.timestamp_micros(F.max("_to") + F.lit(width)).alias("session_end"),
        F.sum("_n").alias("events"),
    ).drop("_no")


def windowed(df: DataFrame, kind: str, keys: list[str], size: int, slide: int | None = None, at: str = "received_at") -> DataFrame:
    """One entry point: ``tumbling``, ``sliding`` or ``session``."""
    if kind == "tumbling":
        return tumbling(df, keys, size, at)
    if kind == "sliding":
        return sliding(df, keys, size, slide or size, at)
    if kind == "session":
        if len(keys) != 1:
            raise ValueError("a session window has exactly one key")
        return sessions(df, keys[0], size, at)
    raise ValueError("kind must be tumbling, sliding or session")


def amount(data: Column) -> Column:
    return F.get_json_object(data, "$.amount").cast("double")


def aggregate_events(df: DataFrame, size: int = HOUR, at: str = "received_at", exact_users: bool = True) -> DataFrame:
    """Per window and event type: events, distinct users, sum and mean of the amount."""
    users = F.count_distinct("user_id") if exact_users else F.approx_count_distinct("user_id")
    value = amount(F.col("data"))
    return (
        df.groupBy(F.window(at, f"{size} seconds").alias("w"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            users.alias("users"),
            F.sum(value).alias("amount_sum"),
            F.avg(value).alias("amount_mean"),
        )
        .select(F.col("w.start").alias("window_start"), "event_type", "events", "users", "amount_sum", "amount_mean")
    )
