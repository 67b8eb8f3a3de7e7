"""The ingest flow: defaults, rules, dedup, outcome, routing."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.functions.envelope import topic_for
from weirgate.operators.batches import guard_batches, refused_requests, request_rejections
from weirgate.operators.dedup import mark_admitted, mark_admitted_with_state
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.outcome import acknowledgements, rejections, with_outcome
from weirgate.operators.validation import invalid_rows, valid_rows, validate
from weirgate.session import cut_lineage
from weirgate.settings import DEFAULTS, Settings
from weirgate.sinks.tables import dead_letter_rows
from weirgate.sinks.topics import dead_letter_records, published_records

# What each way in checks by default.
ENTRY_MODES = {"single": "full", "batch": "annotations", "stream": "full"}


@dataclass(frozen=True)
class Ingested:
    """Every row of the input is in exactly one of ``outcomes`` and ``invalid``; both are lazy."""

    outcomes: DataFrame
    invalid: DataFrame
    settings: Settings
    by_request: bool = False

    def stored(self, path: str) -> Ingested:
        """The same with the outcomes written to ``path`` and read back, for several outputs."""
        self.outcomes.write.mode("overwrite").parquet(path)
        return replace(self, outcomes=self.outcomes.sparkSession.read.schema(self.outcomes.schema).parquet(path))

    @property
    def acks(self) -> DataFrame:
        return acknowledgements(self.outcomes)

    @property
    def rejects(self) -> DataFrame:
        return request_rejections(self.invalid) if self.by_request else rejections(self.invalid)

    @property
    def published(self) -> DataFrame:
        return published_records(self.outcomes, self.settings)

    @property
    def dead_letters(self) -> DataFrame:
        return dead_letter_rows(self.outcomes)

    @property
    def dead_letter_records(self) -> DataFrame:
        return dead_letter_records(self.outcomes, self.settings)


def check(
    events: DataFrame, entry: str = "single", mode: str | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Defaults and rules: every row of an accepted request plus its ``errors``."""
    rows = guard_batches(events, settings).accepted if entry == "batch" else events
    return validate(fill_defaults(rows), mode or ENTRY_MODES[entry], settings)


def admit(
    checked: DataFrame, state: DataFrame | None = None, settings: Settings = DEFAULTS, by_request: bool = False
) -> Ingested:
    """Dedup, outcome and routing of checked rows; ``by_request`` refuses requests with an invalid event whole."""
    accepted, invalid = refused_requests(checked) if by_request else (valid_rows(checked), invalid_rows(checked))
    good = accepted.drop("errors")
    marked = (
        mark_admitted(good, settings) if state is None else mark_admitted_with_state(good, state, settings)
    )
    return Ingested(with_outcome(marked), invalid, settings, by_request)


def ingest(
    events: DataFrame,
    entry: str = "single",
    mode: str | None = None,
    state: DataFrame | None = None,
    settings: Settings = DEFAULTS,
) -> Ingested:
    """Run the flow over decoded events.

    ``events`` needs event_id, event_type, user_id, event_ts, received_at and seq; a batch also
    needs batch_id. ``state`` holds the admissions of earlier increments. Checked rows are
    written once: dedup reads three narrow columns of them several times, and JSON and rules
    are not worked through again.
    """
    # A request is decoded with its annotations: one event that fails them fails the request.
    by_request = entry == "batch" and (mode or ENTRY_MODES[entry]) == "annotations"
    return admit(cut_lineage(check(events, entry, mode, settings)), state, settings, by_request)


def route_counts(events: DataFrame) -> DataFrame:
    """Events per routed topic; rows without a type have none."""
    return (
        events.filter("event_type IS NOT NULL")
        .groupBy(topic_for(F.col("event_type")).alias("topic"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
