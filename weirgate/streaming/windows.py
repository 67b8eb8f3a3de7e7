"""Windows over a stream with a watermark on the arrival time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirgate.functions.timeaxis import shift
from weirgate.operators.windows import amount
from weirgate.session import cut_lineage
from weirgate.sinks.commits import CommitLog, Run, day_of

MARKS = "mark timestamp"


def stream_windowed(
    events: DataFrame, kind: str, keys: list[str], size: str, slide: str | None = None,
    delay: str = "1 hour", at: str = "received_at",
) -> DataFrame:
    late = events.withWatermark(at, delay)
    if kind == "session":
        span = F.session_window(at, size)
    elif kind == "sliding":
        span = F.window(at, size, slide or size)
    elif kind == "tumbling":
        span = F.window(at, size)
    else:
        raise ValueError("kind must be tumbling, sliding or session")
    return (
        late.groupBy(span.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events")
    )


def closing_row(rows: DataFrame, size: str, delay: str = "1 hour", at: str = "received_at") -> DataFrame:
    """One row without keys for the end of a stream: the watermark passes the end of all windows of ``rows`` with it.

    Its own window stays open, so it is never emitted. Rows that come after it are late.
    """
    # A watermark has milliseconds, so a second more is enough.
    last = F.max(at) + F.expr(f"INTERVAL {size}") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 second")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != at]
    return rows.agg(last.alias(at)).select(*empty, at).select(*rows.columns)


def stream_aggregate(events: DataFrame, size: str = "1 hour", delay: str = "1 hour", at: str = "received_at") -> DataFrame:
    value = amount(F.col("data"))
    return (
        events.withWatermark(at, delay)
        .groupBy(F.window(at, size).alias("w"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.approx_count_distinct("user_id").alias("users"),
            F.sum(value).alias("amount_sum"),
            F.avg(value).alias("amount_mean"),
        )
        .select(F.col("w.start").alias("window_start"), "event_type", "events", "users", "amount_sum", "amount_mean")
    )


def window_batch(rows: DataFrame, number: int, log: CommitLog, keys: list[str], seconds: int, delay_seconds: int, writer: str, at: str = "received_at") -> bool:
    """One micro-batch into the store of tumbling windows: no row is dropped.

    Rows behind the watermark (the newest instant of earlier batches less the delay) go to the table
    ``late`` as they are. The others are counted by window and added to the counts of the days they
    touch. The windows of a day are current after every commit, whether the watermark has passed them or not.
    """
    rows = cut_lineage(rows)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    windows = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "window_start timestamp, events bigint"])
    start = F.timestamp_seconds(F.unix_timestamp(F.col(at).cast("timestamp")) - F.pmod(F.unix_timestamp(F.col(at).cast("timestamp")), F.lit(seconds)))

    def work(run: Run) -> None:
        mark = run.read("marks", MARKS).agg(F.max("mark")).first()[0]
        behind = F.lit(False) if mark is None else F.col(at).cast("timestamp") < shift(F.lit(mark), -delay_seconds)
        run.write("late", rows.filter(behind))
        counted = rows.filter(~behind).groupBy(*keys, start.alias("window_start")).agg(F.count(F.lit(1)).alias("events"))
        counted = cut_lineage(counted.withColumn("window_day", F.to_date("window_start")))
        days = {r[0].isoformat() for r in counted.select("window_day").distinct().collect()}
        old = [p for p in run.base.parts.get("windows", ()) if day_of(p) in days]
        run.reads.add("windows")
        merged = run.log.rows("windows", old, windows).drop("run").unionByName(counted.drop("window_day"))
        merged = merged.groupBy(*keys, "window_start").agg(F.sum("events").alias("events"))
        run.write("windows", merged.withColumn("window_day", F.to_date("window_start")).repartition("window_day"), by=("window_day",))
        run.remove("windows", old)
        run.remove("marks", run.base.parts.get("marks", ()))
        run.write("marks", rows.agg(F.greatest(F.max(F.col(at).cast("timestamp")), F.lit(mark).cast("timestamp")).alias("mark")))

    return log.retried(work, writer, number)


def store_windows(events: DataFrame, root: str, checkpoint: str, keys: list[str], seconds: int, delay_seconds: int, at: str = "received_at") -> StreamingQuery:
    """Start the stream that keeps a store of tumbling windows below ``root`` until its backlog is empty."""
    spark = events.sparkSession
    log = CommitLog(spark, root)
    names = [*dict.fromkeys([*keys, at])]

    def each(df: DataFrame, number: int) -> None:
        window_batch(df.select(*names), number, log, keys, seconds, delay_seconds, checkpoint, at)

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_windows(spark: SparkSession, root: str, schema: str, seconds: int) -> DataFrame:
    """``schema`` are the key columns."""
    rows = CommitLog(spark, root).read("windows", f"{schema}, window_start timestamp, events bigint").drop("run")
    return rows.withColumn("window_end", shift(F.col("window_start"), seconds))
