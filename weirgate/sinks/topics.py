"""Published records and the topic sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.functions.envelope import headers, partition_for, wire_value
from weirgate.operators.normalise import with_optional_columns
from weirgate.operators.outcome import FAILED, PROCESSED
from weirgate.operators.rollups import estimated
from weirgate.settings import DEFAULTS, Settings

RECORD = "topic string, partition int, key string, value string, headers array<struct<key:string,value:binary>>, received_at timestamp, seq bigint"


ORDER = ("topic", "partition", "key", "received_at", "seq")


def in_key_order(rows: DataFrame) -> DataFrame:
    """Per-key order in and across files.

    Ranges over (topic, partition, key, time) keep each key's records consecutive and in order
    and still let a hot key span several tasks, which a hash of the key would not.
    """
    return rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def _records(df: DataFrame, key: str, settings: Settings, ordered: bool) -> DataFrame:
    placed = with_optional_columns(df).withColumns(
        {
            "partition": partition_for(F.col("topic"), F.col(key)),
            "key": F.col(key),
            "received_at": F.col("received_at").cast("timestamp"),
            "seq": F.col("seq").cast("bigint"),
        }
    )
    # Ordered before encoding: finding the ranges reads the rows once more.
    full = in_key_order(placed) if ordered else placed
    names = ("event_id", "event_type", "user_id", "event_ts", "data", "metadata", "correlation_id", "source", "version")
    return full.select(
        "topic", "partition", "key",
        wire_value(*[F.col(n) for n in names], omit_nulls=settings.omit_null_fields).alias("value"),
        headers(F.col("correlation_id"), F.col("event_type"), F.col("source"), F.col("version")).alias("headers"),
        "received_at", "seq",
    )


def published_records(outcomes: DataFrame, settings: Settings = DEFAULTS, ordered: bool = True) -> DataFrame:
    """Records of the processed events, keyed by user, in key order."""
    return _records(outcomes.filter(F.col("outcome") == PROCESSED), "user_id", settings, ordered)


def dead_letter_records(outcomes: DataFrame, settings: Settings = DEFAULTS, ordered: bool = True) -> DataFrame:
    """Records of the failed events, keyed by event id, in key order."""
    failed = outcomes.filter(F.col("outcome") == FAILED).withColumn("topic", F.lit(fv.DEAD_LETTER_TOPIC))
    return _records(failed, "event_id", settings, ordered)


def aggregated_records(rollups: DataFrame) -> DataFrame:
    """Rollups as records of the topic of aggregates, keyed by event type; a later record of a window replaces the earlier.

    They are few and carry no order, so the broker's client may choose the partition.
    """
    return estimated(rollups).select(
        F.lit(fv.AGGREGATE_TOPIC).alias("topic"), F.lit(None).cast("int").alias("partition"), F.col("event_type").alias("key"),
        F.to_json(F.struct("window_start", "event_type", "events", "users", "amount_sum", "amount_mean")).alias("value"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
        F.col("window_start").alias("received_at"), F.lit(0).cast("bigint").alias("seq"),
    )


def publish(records: DataFrame, path: str, mode: str = "append") -> None:
    """Write the records below one folder per topic; returns once they are committed."""
    records.write.mode(mode).partitionBy("topic").parquet(path)


def publish_sync(records: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """`publish`, then what the sink now holds per topic."""
    publish(records, path, mode)
    return delivered(records.sparkSession, path).groupBy("topic").agg(F.count(F.lit(1)).alias("delivered"))


def delivered(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(path)


def publish_kafka(records: DataFrame, options: dict[str, str]) -> None:
    """The same records to Kafka; needs the connector on the class path (not tested here).

    The broker client picks the partition from the key.
    """
    defaults = {"kafka.acks": "all", "kafka.retries": "3", "kafka.enable.idempotence": "true", "includeHeaders": "true"}
    records.select("topic", "key", "value", "headers").write.format("kafka").options(**{**defaults, **options}).save()
