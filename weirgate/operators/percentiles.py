"""Percentiles: exact by counting, or approximate by sketch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, probs: tuple[float, ...], cells: int = 64
) -> DataFrame:
    """(keys..., quantile, result): linear interpolation between the two nearest ranks.

    Equal values are counted together before the shuffle and values are grouped into cells, whose
    bounds a mergeable sketch takes from the key's own distribution, so a cell holds about one in
    ``cells`` of the key's rows whatever the unit. The running count over cells tells which cells hold the wanted ranks, and only those are
    sorted, each in its own group. A key with most of the rows is never sorted as a whole.
    """
    known = df.filter(F.col(value).isNotNull())
    steps = [i / cells for i in range(1, cells)]
    sketch = known.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.percentile_approx(value, steps, 4 * cells).alias("_bounds")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    counts = (
        known.groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(sketch, same)
        .select(*keys, F.size(F.filter("_bounds", lambda b: b <= F.col("_v"))).alias("_cell"), "_v", "_n")
    )
    upto = W.partitionBy(*keys).orderBy("_cell").rowsBetween(W.unboundedPreceding, 0)
    filled = (
        counts.groupBy(*keys, "_cell")
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_before", F.sum("_in").over(upto) - F.col("_in"))
        .withColumn("_total", F.sum("_in").over(W.partitionBy(*keys)))
    )
    positions = [F.lit(p) * (F.col("_total") - 1) for p in probs]
    ranks = F.array_distinct(
        F.array(*[r.cast("bigint") for x in positions for r in (F.floor(x), F.ceil(x))])
    )
    wanted = filled.withColumn(
        "_ranks",
        F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_in"))),
    ).filter(F.size("_ranks") > 0)
    inside = W.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    picked = (
        counts.join(wanted, [*keys, "_cell"])
        .withColumn("_end", F.sum("_n").over(inside) + F.col("_before"))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_hit", F.explode(F.filter("_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_end")))))
    )
    by_rank = picked.groupBy(*keys, "_total").agg(
        F.map_from_entries(F.collect_list(F.struct("_hit", "_v"))).alias("_at")
    )
    quantile = F.explode(F.array(*[F.lit(p) for p in probs])).alias("quantile")
    position = F.col("quantile") * (F.col("_total") - 1)
    low = F.element_at("_at", F.floor(position).cast("bigint"))
    high = F.element_at("_at", F.ceil(position).cast("bigint"))
    return by_rank.select(*keys, "_total", "_at", quantile).select(
        *keys, "quantile", (low + (high - low) * (position - F.floor(position))).alias("result")
    )


def approx_percentiles(
    df: DataFrame, keys: list[str], value: str, probs: tuple[float, ...], accuracy: int = 10_000
) -> DataFrame:
    """The same shape from a mergeable sketch, for live panels."""
    sketched = df.groupBy(*keys).agg(F.percentile_approx(value, list(probs), accuracy).alias("_r"))
    quantiles = F.array(*[F.lit(p) for p in probs])
    return sketched.select(*keys, F.explode(F.arrays_zip(quantiles.alias("q"), F.col("_r").alias("r"))).alias("x")).select(
        *keys, F.col("x.q").alias("quantile"), F.col("x.r").alias("result")
    )
