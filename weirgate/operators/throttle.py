"""Rate limit per user and minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from weirgate.functions.timeaxis import bucket_start


def throttle(
    df: DataFrame,
    limit: int,
    key: str = "user_id",
    period: int = 60,
    at: str = "received_at",
    order: tuple[str, ...] = ("received_at", "seq", "event_id"),
) -> DataFrame:
    """All rows plus ``throttled``: true beyond the first ``limit`` of a key in a period.

    The rank filter is applied before the shuffle as well (a group limit), so a hot key sends at
    most ``limit`` rows per input partition to its group. The rows are then matched one to one.
    ``order`` must identify a row.
    """
    first = W.partitionBy(key, "_period").orderBy(*order)
    identity = list(dict.fromkeys(order))
    passed = (
        df.select(key, bucket_start(F.col(at), period).alias("_period"), *[c for c in identity if c != key])
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= limit)
        .select(*identity, F.lit(True).alias("_passed"))
    )
    return df.join(passed, identity, "left").select(
        *[df[c] for c in df.columns], F.col("_passed").isNull().alias("throttled")
    )
