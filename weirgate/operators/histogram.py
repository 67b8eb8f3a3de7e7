"""Cumulative latency histograms and quantiles read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.fixed_values import RATE_STEP_SECONDS
from weirgate.operators.rates import sliding_counts

DEFAULT_BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 150.0, 250.0, 500.0)


def latency_histogram(
    df: DataFrame, keys: list[str], value: str, bounds: tuple[float, ...] = DEFAULT_BOUNDS
) -> DataFrame:
    """(keys..., le, cumulative), one pass; the last bound is +Inf."""
    observed = df.filter(F.col(value).isNotNull())
    wide = observed.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(bounds)],
        F.count(F.lit(1)).alias("_inf"),
    )
    entries = F.array(
        *[F.struct(F.lit(b).alias("le"), F.col(f"_b{i}").alias("cumulative")) for i, b in enumerate(bounds)],
        F.struct(F.lit(float("inf")).alias("le"), F.col("_inf").alias("cumulative")),
    )
    return wide.select(*keys, F.explode(entries).alias("x")).select(*keys, "x.le", "x.cumulative")


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """(keys..., result) by linear interpolation in the first bucket that reaches the rank.

    Buckets of several series are summed by bound first. The lowest bucket starts at 0; a rank
    in the +Inf bucket gives the highest finite bound; no observations give null.
    """
    summed = buckets.groupBy(*keys, "le").agg(F.sum("cumulative").alias("cumulative"))
    lined = summed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("le", "cumulative"))).alias("_b"))
    return _interpolate(lined, keys, q)


def _interpolate(lined: DataFrame, keys: list[str], q: float) -> DataFrame:
    staged = lined.withColumn("_rank", F.lit(q) * F.element_at("_b", -1)["cumulative"]).withColumn(
        "_below", F.filter("_b", lambda x: x["cumulative"] < F.col("_rank"))
    )
    hit = F.get("_b", F.size("_below"))
    floor_le = F.when(F.size("_below") > 0, F.element_at("_below", -1)["le"]).otherwise(F.lit(0.0))
    floor_n = F.when(F.size("_below") > 0, F.element_at("_below", -1)["cumulative"]).otherwise(F.lit(0))
    share = (F.col("_rank") - floor_n) / (hit["cumulative"] - floor_n)
    result = (
        F.when(F.element_at("_b", -1)["cumulative"] == 0, F.lit(None).cast("double"))
        .when(hit["le"] == F.lit(float("inf")), F.get("_b", F.size("_b") - 2)["le"])
        .otherwise(floor_le + (hit["le"] - floor_le) * share)
    )
    return staged.select(*keys, result.alias("result"))


def rolling_histogram_quantile(
    df: DataFrame,
    value: str,
    q: float,
    width: int = 300,
    step: int = RATE_STEP_SECONDS,
    bounds: tuple[float, ...] = DEFAULT_BOUNDS,
    at: str = "received_at",
) -> DataFrame:
    """(window_start, window_end, result): the quantile of each sliding window's buckets."""
    counts = {f"_b{i}": (F.col(value) <= F.lit(b)).cast("int") for i, b in enumerate(bounds)}
    counts["_inf"] = F.lit(1)
    observed = df.filter(F.col(value).isNotNull())
    wide = sliding_counts(observed, [], counts, width, step, at)
    buckets = [F.struct(F.lit(b).alias("le"), F.col(f"_b{i}").alias("cumulative")) for i, b in enumerate(bounds)]
    last = F.struct(F.lit(float("inf")).alias("le"), F.col("_inf").alias("cumulative"))
    lined = wide.select("window_start", "window_end", F.array(*buckets, last).alias("_b"))
    return _interpolate(lined, ["window_start", "window_end"], q)
