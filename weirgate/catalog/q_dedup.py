"""Dedup, outcome and membership: j01, d01, d03, d04."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.catalog.registry import batched, outcomes, query, wire
from weirgate.catalog.sql import BATCH, outcome_sql, wire_sql
from weirgate.operators.batches import guard_batches
from weirgate.operators.dedup import (
    mark_admitted, mark_admitted_with_state, next_state, not_seen_before, seen_before,
)
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.outcome import batch_responses, batch_tally, with_outcome
from weirgate.settings import Settings

HALF = "2024-01-16 00:00:00"


@query(
    "j01_seen_before",
    wire_sql(f"""SELECT w.event_id, w.attempt,
  coalesce(w.received_at < s.admitted_at + INTERVAL 24 HOUR, FALSE) AS seen
FROM (SELECT * FROM wire WHERE received_at >= TIMESTAMP '{HALF}') w LEFT JOIN (
  SELECT event_id, max(received_at) AS admitted_at FROM wire WHERE received_at < TIMESTAMP '{HALF}' GROUP BY event_id) s
  ON w.event_id = s.event_id"""),
)
def j01(spark, sf_dir):
    """Second half of the month against the last arrivals of the first half."""
    rows = wire(spark, sf_dir)
    half = F.lit(HALF).cast("timestamp")
    state = rows.filter(F.col("received_at") < half).groupBy("event_id").agg(F.max("received_at").alias("admitted_at"))
    later = rows.filter(F.col("received_at") >= half)
    seen = seen_before(later, state).select("event_id", "attempt", F.lit(True).alias("seen"))
    fresh = not_seen_before(later, state).select("event_id", "attempt", F.lit(False).alias("seen"))
    return seen.unionByName(fresh)


@query("d01_ttl_dedup", outcome_sql("SELECT event_id, attempt, received_at, admitted FROM outcomes"))
def d01(spark, sf_dir):
    return mark_admitted(wire(spark, sf_dir)).select("event_id", "attempt", "received_at", "admitted")


@query("d01_incremental_dedup", outcome_sql("SELECT event_id, attempt, admitted FROM outcomes"))
def d01_incremental(spark, sf_dir):
    """Two increments with the seen-set carried over give what one run gives."""
    rows = wire(spark, sf_dir)
    half = F.lit(HALF).cast("timestamp")
    first = mark_admitted(rows.filter(F.col("received_at") < half))
    empty = first.select("event_id", F.col("received_at").alias("admitted_at")).limit(0)
    state = next_state(empty, first, half)
    second = mark_admitted_with_state(rows.filter(F.col("received_at") >= half), state)
    return first.unionByName(second).select("event_id", "attempt", "admitted")


@query(
    "d01_equal_keys",
    outcome_sql("""SELECT fold_limit, event_id, attempt, CASE WHEN n % 3 = 0 THEN 2 ELSE 1 END AS arrived, CAST(admitted AS BIGINT) AS won
FROM outcomes, (VALUES (0), (10000)) AS v(fold_limit)"""),
)
def d01_equal_keys(spark, sf_dir):
    """A third of the rows come twice at one instant and place; one of each pair can win, whichever way dedup goes."""
    rows = wire(spark, sf_dir)
    twice = rows.unionByName(rows.filter("n % 3 = 0"))

    def tally(limit: int):
        marked = mark_admitted(twice, Settings(fold_limit=limit))
        counts = marked.groupBy("event_id", "attempt").agg(F.count(F.lit(1)).alias("arrived"), F.count_if("admitted").alias("won"))
        return counts.withColumn("fold_limit", F.lit(limit))

    return tally(0).unionByName(tally(10_000))


@query("d01_second_run", wire_sql("SELECT event_id, attempt, FALSE AS admitted FROM wire"))
def d01_second_run(spark, sf_dir):
    """The same input once more, with the admissions of the first run stored."""
    rows = wire(spark, sf_dir)
    first = mark_admitted(rows).filter("admitted").select("event_id", F.col("received_at").alias("admitted_at"))
    return mark_admitted_with_state(rows, first).select("event_id", "attempt", "admitted")


@query("d03_outcomes", outcome_sql("SELECT event_id, attempt, event_type, outcome FROM outcomes"))
def d03(spark, sf_dir):
    return outcomes(spark, sf_dir).select("event_id", "attempt", "event_type", "outcome")


_GUARDED = f"""batches AS (SELECT *, {BATCH} FROM wire), guarded AS (
  SELECT * FROM batches WHERE batch_id NOT IN (SELECT batch_id FROM batches GROUP BY batch_id HAVING count(*) > 1000))"""


@query(
    "d04_batch_tally",
    outcome_sql(
        """SELECT batch_id, count(*) FILTER (WHERE outcome <> 'failed') AS success_count,
  count(*) FILTER (WHERE outcome = 'failed') AS failure_count,
  coalesce(string_agg(event_id, ',' ORDER BY received_at, attempt, event_id) FILTER (WHERE outcome = 'failed'), '') AS failed_event_ids
FROM outcomes GROUP BY batch_id""",
        before=(_GUARDED,),
        source="guarded",
    ),
)
def d04(spark, sf_dir):
    accepted = guard_batches(batched(wire(spark, sf_dir))).accepted
    tally = batch_tally(with_outcome(mark_admitted(fill_defaults(accepted))))
    return tally.withColumn("failed_event_ids", F.concat_ws(",", "failed_event_ids"))


@query(
    "d04_batch_response",
    outcome_sql(
        """SELECT batch_id, count(*) AS total_events, count(*) FILTER (WHERE outcome <> 'failed') AS success_count,
  count(*) FILTER (WHERE outcome = 'failed') AS failure_count
FROM outcomes GROUP BY batch_id""",
        before=(_GUARDED,),
        source="guarded",
    ),
)
def d04_response(spark, sf_dir):
    accepted = guard_batches(batched(wire(spark, sf_dir))).accepted
    return batch_responses(with_outcome(mark_admitted(fill_defaults(accepted)))).drop("failed_event_ids")
