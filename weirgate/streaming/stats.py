"""Live statistics pushed on a timer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirgate import fixed_values as fv
from weirgate.operators.totals import counts_per_type, snapshot_from_counts


def start_stats(
    outcomes: DataFrame,
    path: str,
    checkpoint: str,
    every_millis: int | None = fv.STATS_PUSH_MILLIS,
) -> StreamingQuery:
    """One snapshot per trigger with its sequence number; a replay overwrites its own.

    ``outcomes`` is a stream. ``every_millis=None`` drains the backlog and stops.
    """

    def push(per_type: DataFrame, sequence: int) -> None:
        snapshot = snapshot_from_counts(per_type).withColumn("sequence", F.lit(sequence).cast("bigint"))
        snapshot.write.mode("overwrite").parquet(f"{path}/push={sequence}")

    writer = (
        counts_per_type(outcomes)
        .writeStream.outputMode("complete")
        .foreachBatch(push)
        .option("checkpointLocation", checkpoint)
    )
    if every_millis is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_millis} milliseconds").start()
