"""The stored tables: events, dead letters and hourly metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate import fixed_values as fv
from weirgate.functions.envelope import wire_value
from weirgate.functions.rules import collected
from weirgate.operators.normalise import with_optional_columns
from weirgate.operators.outcome import FAILED, PROCESSED, failure_reason
from weirgate.operators.rollups import ROLLUP, hourly_rollup, merge_rollups
from weirgate.operators.totals import hourly_metrics
from weirgate.session import cut_lineage
from weirgate.sinks.commits import CommitLog, Run, day_of

EVENTS = (
    "event_id string, event_type string, user_id string, source string, version string, "
    "correlation_id string, data string, metadata map<string,string>, event_ts timestamp, created_at timestamp"
)
DEAD_LETTERS = (
    "event_id string, event_type string, user_id string, raw_payload string, error_reason string, "
    "retry_count int, created_at timestamp, last_retried_at timestamp"
)
HOURLY = "hour_bucket timestamp, event_type string, total_count bigint, success_count bigint, failure_count bigint"


def too_long(limits: dict[str, int]) -> Column:
    """Names of the columns whose text exceeds its width."""
    return collected(*[F.when(F.char_length(F.col(c)) > n, F.lit(c)) for c, n in limits.items()])


def within_limits(df: DataFrame, limits: dict[str, int] = fv.EVENT_COLUMN_LIMITS) -> DataFrame:
    return df.filter(F.size(too_long(limits)) == 0)


def over_limits(df: DataFrame, limits: dict[str, int] = fv.EVENT_COLUMN_LIMITS) -> DataFrame:
    return df.withColumn("too_long", too_long(limits)).filter(F.size("too_long") > 0)


def quarantined(rows: DataFrame, limits: dict[str, int] = fv.EVENT_COLUMN_LIMITS) -> DataFrame:
    """What a table with these widths cannot take: the whole row as JSON, with the columns at fault."""
    found = over_limits(rows, limits)
    whole = F.to_json(F.struct(*[F.col(c) for c in rows.columns]))
    return found.select("event_id", "too_long", whole.alias("row"), F.col("created_at").alias("created_at"))


def event_rows(outcomes: DataFrame) -> DataFrame:
    """Processed events as rows of the events table, one per event id (the first to arrive).

    The first arrival is a minimum over a narrow struct, combined before the shuffle; the
    payload columns follow by a join on the whole row key.
    """
    full = with_optional_columns(outcomes.filter(F.col("outcome") == PROCESSED))
    firsts = full.groupBy("event_id").agg(F.min(F.struct("received_at", "seq")).alias("f")).select(
        "event_id", "f.received_at", "f.seq"
    )
    rows = full.join(firsts, ["event_id", "received_at", "seq"], "left_semi")
    return rows.select(
        "event_id", "event_type", "user_id",
        F.coalesce("source", F.lit(fv.DEFAULT_SOURCE)).alias("source"),
        F.coalesce("version", F.lit(fv.DEFAULT_VERSION)).alias("version"),
        "correlation_id", "data", "metadata",
        F.col("event_ts").cast("timestamp").alias("event_ts"),
        F.col("received_at").cast("timestamp").alias("created_at"),
    )


def new_event_rows(rows: DataFrame, existing: DataFrame, limits: dict[str, int] = fv.EVENT_COLUMN_LIMITS) -> DataFrame:
    """Rows whose id the table does not hold yet; rows over the column widths go to `quarantined`.

    The table is first cut down to the ids of the rows, so only its id column is read and, while the
    rows are few, nothing of it is shuffled.
    """
    fresh = within_limits(rows, limits)
    known = existing.select("event_id").join(fresh.select("event_id"), "event_id", "left_semi")
    return fresh.join(known, "event_id", "left_anti")


def insert_events(run: Run, rows: DataFrame, limits: dict[str, int] = fv.EVENT_COLUMN_LIMITS) -> None:
    """Unique insert, in a folder per day of arrival, with a Bloom filter for looking up ids. Write `quarantined` rows beside it."""
    fresh = new_event_rows(rows, run.read("events", "event_id string"), limits)
    dated = fresh.withColumn("created_on", F.to_date("created_at"))
    run.write("events", dated, by=("created_on",), **{"parquet.bloom.filter.enabled#event_id": "true"})


def dead_letter_rows(outcomes: DataFrame) -> DataFrame:
    failed = with_optional_columns(outcomes.filter(F.col("outcome") == FAILED))
    names = ("event_id", "event_type", "user_id", "event_ts", "data", "metadata", "correlation_id", "source", "version")
    # A failed event is always stored: its payload has the full text of what the columns cannot hold.
    limits = fv.DEAD_LETTER_COLUMN_LIMITS
    return failed.select(
        *[F.substring(F.col(c), 1, limits[c]).alias(c) if c in limits else F.col(c) for c in ("event_id", "event_type", "user_id")],
        wire_value(*[F.col(n) for n in names]).alias("raw_payload"),
        failure_reason(F.col("event_type")).alias("error_reason"),
        F.lit(0).alias("retry_count"),
        F.col("received_at").cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("last_retried_at"),
    )


def write_dead_letters(rows: DataFrame, path: str, mode: str = "append") -> None:
    rows.write.mode(mode).parquet(path)


def merge_hourly(stored: DataFrame, increment: DataFrame) -> DataFrame:
    """Upsert that adds: counts of the same (hour, type) are summed."""
    return stored.unionByName(increment).groupBy("hour_bucket", "event_type").agg(
        F.sum("total_count").alias("total_count"),
        F.sum("success_count").alias("success_count"),
        F.sum("failure_count").alias("failure_count"),
    )


def upsert_hourly(run: Run, outcomes: DataFrame) -> None:
    """Adds the increment's counts. Only the days it touches are rewritten, other days keep their files."""
    increment = cut_lineage(hourly_metrics(outcomes).withColumn("metric_day", F.to_date("hour_bucket")))
    days = {r["metric_day"].isoformat() for r in increment.select("metric_day").distinct().collect()}
    run.reads.add("hourly")
    old = [p for p in run.base.parts.get("hourly", ()) if day_of(p) in days]
    merged = merge_hourly(run.log.rows("hourly", old, HOURLY).drop("run"), increment.drop("metric_day"))
    run.write("hourly", merged.withColumn("metric_day", F.to_date("hour_bucket")).repartition("metric_day"), by=("metric_day",))
    run.remove("hourly", old)


def current_hourly(log: CommitLog) -> DataFrame:
    return log.read("hourly", HOURLY).drop("run")


def add_rollup(run: Run, events: DataFrame) -> DataFrame:
    """Adds events to the stored hourly rollups and returns the hours they touch, as they are now.

    Only the days of the increment are rewritten.
    """
    increment = cut_lineage(hourly_rollup(events))
    days = {r[0].isoformat() for r in increment.select(F.to_date("window_start")).distinct().collect()}
    run.reads.add("rollups")
    old = [p for p in run.base.parts.get("rollups", ()) if day_of(p) in days]
    merged = merge_rollups(run.log.rows("rollups", old, ROLLUP).drop("run").unionByName(increment))
    path = run.write("rollups", merged.withColumn("rollup_day", F.to_date("window_start")).repartition("rollup_day"), by=("rollup_day",))
    run.remove("rollups", old)
    stored = run.log.spark.read.schema(ROLLUP).parquet(path)
    return stored.join(increment.select("window_start", "event_type"), ["window_start", "event_type"], "left_semi")


def stored_rollups(log: CommitLog, unit: str = "hour") -> DataFrame:
    """The rollups per hour, or merged into days or weeks."""
    rows = log.read("rollups", ROLLUP).drop("run")
    return rows if unit == "hour" else merge_rollups(rows, unit)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    names = T.StructType.fromDDL(schema).names
    return spark.read.schema(schema).parquet(path).select(*names)
