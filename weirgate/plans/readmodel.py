"""Read models: tables shaped for the questions asked of them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.operators.outcome import PROCESSED
from weirgate.operators.totals import hourly_metrics


class ReadModel(NamedTuple):
    latest_by_user: DataFrame
    counts_by_user_type: DataFrame
    hourly: DataFrame


def read_model(outcomes: DataFrame) -> ReadModel:
    """Each view is one aggregate that combines before its shuffle."""
    done = outcomes.filter(F.col("outcome") == PROCESSED)
    latest = done.groupBy("user_id").agg(
        F.max(F.struct("received_at", "event_id", "event_type")).alias("last")
    )
    return ReadModel(
        latest.select("user_id", "last.event_id", "last.event_type", F.col("last.received_at").alias("seen_at")),
        done.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("events")),
        hourly_metrics(outcomes),
    )


def materialise(model: ReadModel, root: str) -> None:
    for name, view in model._asdict().items():
        view.write.mode("overwrite").parquet(f"{root}/{name}")


def validated(outcomes: DataFrame) -> DataFrame:
    """All routed rows of every topic in one view: rejects, duplicates and failures stay out."""
    return outcomes.filter(F.col("outcome") == PROCESSED)
