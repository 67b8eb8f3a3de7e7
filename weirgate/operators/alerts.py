"""Bursts of critical events of one user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from weirgate.functions.envelope import is_critical
from weirgate.functions.timeaxis import micros
from weirgate.operators.nearest import slice_of


def critical_bursts(df: DataFrame, n: int = 3, within: int = 600, at: str = "received_at") -> DataFrame:
    """(user_id, alert_at, critical_events) at every instant that ends ``n`` or more within the span.

    Equal instants of a user are counted together before the shuffle. The time line of a user is
    cut into blocks of the span; each block also sees the one before it, so a hot user is spread
    over blocks and every look-back stays inside one group.
    """
    span = within * 1_000_000
    instants = (
        df.filter(is_critical(F.col("event_type")))
        .groupBy("user_id", micros(F.col(at)).alias("_at"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    home = slice_of(F.col("_at"), span)
    copies = instants.withColumn("_home", home).withColumn(
        "_block", F.explode(F.array(F.col("_home"), F.col("_home") + F.lit(span)))
    )
    back = W.partitionBy("user_id", "_block").orderBy("_at").rangeBetween(-span, 0)
    return (
        copies.withColumn("critical_events", F.sum("_n").over(back))
        .filter(F.col("_block") == F.col("_home"))
        .filter(F.col("critical_events") >= n)
        .select("user_id", F.timestamp_micros("_at").alias("alert_at"), "critical_events")
    )
