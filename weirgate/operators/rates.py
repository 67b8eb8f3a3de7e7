"""Per-second rates over sliding windows, from events and from sampled counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from weirgate import fixed_values as fv
from weirgate.functions.timeaxis import bucket_start, micros, shift
from weirgate.operators.outcome import PROCESSED


def sliding_counts(
    df: DataFrame,
    keys: list[str],
    counts: dict[str, Column],
    width: int,
    step: int = fv.RATE_STEP_SECONDS,
    at: str = "received_at",
) -> DataFrame:
    """(keys..., window_start, window_end, counts...) for every window that holds an event.

    Rows are counted per step first; only those counts are copied into the windows they belong
    to, instead of copying each row ``width / step`` times.
    """
    if width % step:
        raise ValueError("width must be a multiple of step")
    cells = df.groupBy(*keys, bucket_start(F.col(at), step).alias("_cell")).agg(
        *[F.sum(c.cast("bigint")).alias(name) for name, c in counts.items()]
    )
    back = F.explode(F.sequence(F.lit(0), F.lit(width - step), F.lit(step))).alias("_back")
    spread = cells.select(*keys, "_cell", *counts, back).withColumn("window_start", shift(F.col("_cell"), -F.col("_back")))
    return (
        spread.groupBy(*keys, "window_start")
        .agg(*[F.sum(name).alias(name) for name in counts])
        .select(*keys, "window_start", shift(F.col("window_start"), width).alias("window_end"), *counts)
    )


def event_rate(df: DataFrame, keys: list[str], width: int, step: int = fv.RATE_STEP_SECONDS, at: str = "received_at") -> DataFrame:
    counted = sliding_counts(df, keys, {"events": F.lit(1)}, width, step, at)
    return counted.withColumn("per_second", F.col("events") / F.lit(float(width)))


def rolling_success(outcomes: DataFrame, width: int = 300, step: int = fv.RATE_STEP_SECONDS) -> DataFrame:
    good = (F.col("outcome") == PROCESSED).cast("int")
    counted = sliding_counts(outcomes, [], {"good": good, "events": F.lit(1)}, width, step)
    return counted.withColumn("success_percent", F.col("good") * F.lit(100.0) / F.col("events"))


def counter_rate(
    samples: DataFrame, series: list[str], width: int = 300, at: str = "sampled_at", value: str = "value"
) -> DataFrame:
    """Reset-aware rate of a counter: a fall counts as a restart from zero.

    A series has one sample per scrape, so its size follows the clock and not the events.
    """
    line = W.partitionBy(*series).orderBy("_at")
    before = F.lag(value).over(line)
    increase = F.when(before.isNull(), F.lit(0)).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    recent = line.rangeBetween(-(width * 1_000_000) + 1, 0)
    return (
        samples.withColumn("_at", micros(F.col(at)))
        .withColumn("_up", increase)
        .withColumn("per_second", F.sum("_up").over(recent) / F.lit(float(width)))
        .drop("_at", "_up")
    )
