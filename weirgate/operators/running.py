"""Running sums in two levels: within a block, plus the totals of the earlier blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def running_totals(df: DataFrame, keys: list[str], block: str, order: str, values: dict[str, str]) -> DataFrame:
    """Cumulative sums (``{column: name}``) per key in ``order``; ``block`` must rise with ``order``.

    No task sorts a whole series: it sorts one block, and the block totals separately.
    """
    before = W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    within = W.partitionBy(*keys, block).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    sums = df.groupBy(*keys, block).agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    offsets = sums.select(
        *keys, block, *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_offset_{v}") for v in values]
    )
    kept = [c for c in df.columns if c not in values and c != block]
    return (
        df.select(*keys, block, *[c for c in kept if c not in keys], *[F.sum(v).over(within).alias(f"_within_{v}") for v in values])
        .join(offsets, [*keys, block])
        .select(*kept, *[(F.col(f"_within_{v}") + F.col(f"_offset_{v}")).cast("bigint").alias(n) for v, n in values.items()])
    )


def running_total(df: DataFrame, keys: list[str], block: str, order: str, value: str, name: str) -> DataFrame:
    return running_totals(df, keys, block, order, {value: name})
