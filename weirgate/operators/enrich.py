"""Enrichment from a dimension and matching of related events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.timeaxis import micros
from weirgate.operators.nearest import nearest_at_or_before


def enrich(df: DataFrame, dimension: DataFrame, on: Column) -> DataFrame:
    """Left join with a dimension of unique keys.

    No broadcast hint: Spark broadcasts the dimension when its measured size is below the
    threshold and splits hot partitions of the fact side otherwise.
    """
    return df.join(dimension, on, "left")


def match_transactions(
    df: DataFrame,
    bound: int = 3600,
    opened: str = "transaction.created",
    closed: str = "transaction.completed",
    at: str = "received_at",
) -> DataFrame:
    """Every ``closed`` event with the user's latest ``opened`` at or before it, within the bound.

    One row per closed event: a user with very many events gives no pairs beyond that.
    """
    slim = df.filter(F.col("event_type").isin(opened, closed)).select(
        "event_id", "user_id", micros(F.col(at)).alias("axis"), (F.col("event_type") == closed).alias("closing")
    )
    span = bound * 1_000_000
    nearest = nearest_at_or_before(
        slim, ["user_id"], "axis", ~F.col("closing"), F.col("closing"), span, "opened_axis"
    ).filter(F.col("axis") - F.col("opened_axis") <= span)
    # Of several opened events at one instant the smallest id stands for them.
    starts = (
        slim.filter("NOT closing")
        .groupBy("user_id", F.col("axis").alias("opened_axis"))
        .agg(F.min("event_id").alias("opened_id"))
    )
    return (
        slim.filter("closing")
        .join(nearest, ["user_id", "axis"])
        .join(starts, ["user_id", "opened_axis"])
        .select(
            "user_id", F.col("event_id").alias("closed_id"), "opened_id",
            F.timestamp_micros("axis").alias("closed_at"), F.timestamp_micros("opened_axis").alias("opened_at"),
        )
    )
