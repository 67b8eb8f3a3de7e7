"""Whole-request decisions: size limit and malformed content."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.operators.validation import accepted_batches, oversized_batches
from weirgate.settings import DEFAULTS, Settings


class Guarded(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def guard_batches(df: DataFrame, settings: Settings = DEFAULTS) -> Guarded:
    return Guarded(accepted_batches(df, settings), oversized_batches(df, settings))


def well_formed(df: DataFrame) -> DataFrame:
    return df.filter("malformed IS NULL").drop("malformed")


def malformed_requests(df: DataFrame) -> DataFrame:
    """Uniform error rows for what could not be decoded."""
    return df.filter("malformed IS NOT NULL").select(
        F.lit(400).alias("status"),
        F.lit("Bad Request").alias("error"),
        F.lit(fv.MALFORMED_BODY).alias("message"),
        F.lit(None).cast("array<string>").alias("details"),
        F.col("malformed").alias("cause"),
        F.col("received_at").alias("timestamp"),
    )


def refused_requests(checked: DataFrame) -> Guarded:
    """A request with one invalid event is refused as a whole: its rows, and the rows of the others.

    Only the ids of such requests are gathered; they are bounded by the rows that fail.
    """
    bad = checked.filter(F.size("errors") > 0).select("batch_id").distinct()
    return Guarded(checked.join(bad, "batch_id", "left_anti"), checked.join(bad, "batch_id", "left_semi"))


def request_rejections(refused: DataFrame) -> DataFrame:
    """One row per refused request: the messages of its events in order. A request's size is limited."""
    told = F.array_sort(F.collect_list(F.when(F.size("errors") > 0, F.struct("seq", "event_id", "errors"))))
    return refused.groupBy("batch_id").agg(told.alias("told")).select(
        F.lit(fv.ANNOTATIONS_FAILED).alias("error"),
        F.flatten(F.transform("told", lambda x: x["errors"])).alias("details"),
        "batch_id",
    )
