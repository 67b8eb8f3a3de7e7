"""Per-event outcome and the response rows built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.functions.envelope import is_unroutable, topic_for

PROCESSED, DUPLICATE, FAILED = "processed", "duplicate", "failed"


def with_outcome(marked: DataFrame) -> DataFrame:
    """``outcome`` and ``topic``. A duplicate is never routed; a failed row goes to the dead letters."""
    outcome = (
        F.when(~F.col("admitted"), F.lit(DUPLICATE))
        .when(is_unroutable(F.col("event_type")), F.lit(FAILED))
        .otherwise(F.lit(PROCESSED))
    )
    routed = marked.withColumn("outcome", outcome)
    return routed.withColumn(
        "topic",
        F.when(F.col("outcome") == PROCESSED, topic_for(F.col("event_type"))).when(
            F.col("outcome") == FAILED, F.lit(fv.DEAD_LETTER_TOPIC)
        ),
    )


def failure_reason(event_type: Column) -> Column:
    return F.when(event_type.isNull(), F.lit("event type is null")).otherwise(
        F.lit("event type has no category")
    )


def acknowledgements(outcomes: DataFrame) -> DataFrame:
    """One row per accepted event. A duplicate is acknowledged like any other."""
    return outcomes.filter(F.col("outcome") != FAILED).select(
        "event_id",
        F.lit(fv.ACCEPTED_STATUS).alias("status"),
        F.lit(fv.ACCEPTED_MESSAGE).alias("message"),
        "correlation_id",
    )


def rejections(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") > 0).select(
        F.lit(fv.VALIDATION_FAILED).alias("error"),
        F.col("errors").alias("details"),
        "correlation_id",
    )


def error_rows(df: DataFrame, status: int, message: Column, details: Column, at: str = "received_at") -> DataFrame:
    """Uniform error rows; ``details`` is null when there are none."""
    reasons = {400: "Bad Request", 500: "Internal Server Error"}
    return df.select(
        "event_id",
        F.lit(status).alias("status"),
        F.lit(reasons[status]).alias("error"),
        message.alias("message"),
        F.when(F.size(details) > 0, details).alias("details"),
        F.col(at).alias("timestamp"),
    )


def batch_tally(outcomes: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Successes (duplicates included), failures and the failed ids in order.

    The id list is bounded by the batch size limit, which is checked before.
    """
    failed = F.col("outcome") == FAILED
    ids = F.array_sort(F.collect_list(F.when(failed, F.struct("received_at", "seq", "event_id"))))
    return outcomes.groupBy(batch).agg(
        F.count_if(~failed).alias("success_count"),
        F.count_if(failed).alias("failure_count"),
        F.transform(ids, lambda x: x["event_id"]).alias("failed_event_ids"),
    )


def batch_responses(outcomes: DataFrame, batch: str = "batch_id") -> DataFrame:
    """What a request is answered with: its tally and the number of its events."""
    return batch_tally(outcomes, batch).withColumn("total_events", F.col("success_count") + F.col("failure_count"))
