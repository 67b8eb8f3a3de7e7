"""Latest earlier point per probe, without one task per key.

A key's time line is cut into slices. Inside a slice a window looks back; a small table of
slice maxima carries the answer across slices. A hot key is spread over its slices, and equal
instants are collapsed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def slice_of(axis: Column, width: int) -> Column:
    """Start of the slice, in whole numbers. Never null, so joins on it add no filter."""
    return F.coalesce(axis - F.pmod(axis, F.lit(width)), F.lit(0))


def nearest_at_or_before(
    marks: DataFrame,
    keys: list[str],
    axis: str,
    is_point: Column,
    is_probe: Column,
    slice_width: int,
    found: str = "found",
) -> DataFrame:
    """For each distinct probe (keys, axis) the largest point of its key at or before it.

    ``marks`` holds points and probes together, so its source is scanned once; ``axis`` is a
    bigint. Probes without an earlier point keep a null.
    """
    line = (
        marks.groupBy(*keys, axis)
        .agg(
            F.max(F.when(is_point, F.col(axis))).alias("_point"),
            F.max(is_probe.cast("int")).alias("_probe"),
        )
        .withColumn("_slice", slice_of(F.col(axis), slice_width))
    )
    inside = W.partitionBy(*keys, "_slice").orderBy(axis).rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    # Only slices with a probe are asked for; reading the flag also lets both branches share
    # one shuffle.
    carried = (
        line.groupBy(*keys, "_slice")
        .agg(F.max("_point").alias("_top"), F.max("_probe").alias("_asked"))
        .withColumn("_carry", F.max("_top").over(earlier))
        .filter("_asked = 1")
        .select(*keys, "_slice", "_carry")
    )
    return (
        line.withColumn("_inside", F.max("_point").over(inside))
        .filter("_probe = 1")
        .join(carried, [*keys, "_slice"])
        .select(*keys, axis, F.coalesce("_inside", "_carry").alias(found))
    )
