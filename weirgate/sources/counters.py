"""Counters and gauges sampled on a fixed grid, as a scraper would see them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from weirgate import fixed_values as fv
from weirgate.functions.timeaxis import bucket_start, shift
from weirgate.operators.outcome import DUPLICATE, FAILED, PROCESSED
from weirgate.operators.running import running_totals
from weirgate.operators.totals import success_gauge


def _sampled(df: DataFrame, series: list[str], counts: dict[str, Column], at: str, interval: int) -> DataFrame:
    """(series..., sampled_at, counts...): cumulative counts before each grid instant.

    Events are first counted per grid cell, so the running sum is over cells. Each series is
    sampled from the end of its first cell to the end of its last one; the gaps between two
    counted cells are filled from the earlier one, without a window over the filled rows.
    """
    cells = df.groupBy(
        *series,
        bucket_start(F.col(at), 86400).alias("_day"),
        shift(bucket_start(F.col(at), interval), interval).alias("sampled_at"),
    ).agg(*[F.count_if(c).alias(f"_{name}") for name, c in counts.items()])
    counted = running_totals(cells, series, "_day", "sampled_at", {f"_{n}": n for n in counts})
    following = F.lead("sampled_at").over(W.partitionBy(*series).orderBy("sampled_at"))
    step = F.expr(f"INTERVAL {interval} SECONDS")
    until = F.coalesce(shift(F.col("_next"), -interval), F.col("sampled_at"))
    return counted.withColumn("_next", following).select(
        *series, F.explode(F.sequence("sampled_at", until, step)).alias("sampled_at"), *counts
    )


def counter_samples(
    df: DataFrame, series: list[str], at: str = "received_at", interval: int = fv.SCRAPE_SECONDS
) -> DataFrame:
    """(series..., sampled_at, value): events seen before each grid instant."""
    return _sampled(df, series, {"value": F.lit(True)}, at, interval)


def metric_samples(outcomes: DataFrame, interval: int = fv.SCRAPE_SECONDS, at: str = "received_at") -> DataFrame:
    """(ts, metric, labels, value): the service's counters and its success gauge.

    All of them are there from the first sample on, at zero until something happens.
    """
    counts = {
        "ingested": F.col("outcome") == PROCESSED,
        "failed": F.col("outcome") == FAILED,
        "duplicates": F.col("outcome") == DUPLICATE,
    }
    sampled = _sampled(outcomes.withColumn("_all", F.lit(1)), ["_all"], counts, at, interval)
    received = F.col("ingested") + F.col("failed") + F.col("duplicates")
    values = {
        "events.ingested": F.col("ingested").cast("double"),
        "events.failed": F.col("failed").cast("double"),
        "events.duplicates": F.col("duplicates").cast("double"),
        "success.rate": success_gauge(F.col("ingested"), received),
    }
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in values.items()])
    return sampled.select(F.col("sampled_at").alias("ts"), F.explode(entries).alias("m")).select(
        "ts", "m.metric", F.create_map().cast("map<string,string>").alias("labels"), "m.value"
    )
