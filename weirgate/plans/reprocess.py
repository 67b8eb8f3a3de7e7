"""Another try for dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.envelope import is_unroutable, topic_for
from weirgate.functions.timeaxis import instant
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.outcome import with_outcome
from weirgate.operators.validation import validate
from weirgate.settings import DEFAULTS, Settings
from weirgate.sources.json_events import decode_lines


def reprocess(
    dead_letters: DataFrame, as_of: Column, settings: Settings = DEFAULTS, mode: str = "annotations"
) -> DataFrame:
    """Dead letters after one more run of their payload, with ``status`` and ``topic``.

    ``recovered`` rows can be routed now, ``failed`` rows wait for another try, ``exhausted``
    rows had used up their tries and are left as they were. A payload that breaks the rules of
    ``mode`` (see `validate`; the clock is the letter's own arrival) fails, and its messages become
    the reason.
    """
    open_rows = F.col("retry_count") < settings.max_retries
    decoded = decode_lines(
        dead_letters.select(
            F.col("event_id").alias("letter_id"), "raw_payload", "error_reason", "retry_count", "created_at", "last_retried_at"
        ),
        body="raw_payload",
        arrived=F.col("created_at"),
    )
    decoded = validate(decoded, mode, settings)
    works = F.col("malformed").isNull() & ~is_unroutable(F.col("event_type")) & (F.size("errors") == 0)
    broken = open_rows & F.col("malformed").isNull() & (F.size("errors") > 0)
    status = F.when(~open_rows, F.lit("exhausted")).when(works, F.lit("recovered")).otherwise(F.lit("failed"))
    return decoded.select(
        F.col("letter_id").alias("event_id"), "event_type", "user_id", "raw_payload",
        F.when(broken, F.array_join("errors", "; ")).otherwise(F.col("error_reason")).alias("error_reason"),
        F.when(open_rows, F.col("retry_count") + 1).otherwise(F.col("retry_count")).alias("retry_count"),
        "created_at",
        F.when(open_rows, instant(as_of)).otherwise(F.col("last_retried_at")).alias("last_retried_at"),
        status.alias("status"),
        F.when(status == "recovered", topic_for(F.col("event_type"))).alias("topic"),
    )


def still_waiting(tried: DataFrame) -> DataFrame:
    """The dead-letter table after a round: what recovered is gone, the others keep their new counts."""
    return tried.filter("status <> 'recovered'").select(
        "event_id", "event_type", "user_id", "raw_payload", "error_reason", "retry_count", "created_at", "last_retried_at"
    )


def recovered_outcomes(tried: DataFrame) -> DataFrame:
    """Recovered letters as processed events, to be stored and published like any other.

    Their ids were admitted when they first arrived, so they are not looked up again.
    """
    letters = tried.filter("status = 'recovered'").select("raw_payload", F.col("created_at").alias("letter_at"))
    events = decode_lines(letters, body="raw_payload", arrived=F.col("letter_at")).drop("raw_payload", "letter_at", "malformed")
    placed = events.withColumns({"admitted": F.lit(True), "seq": F.lit(0).cast("bigint")})
    return with_outcome(fill_defaults(placed, identity=("received_at",)))
