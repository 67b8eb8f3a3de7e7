"""Registration of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.dedup import mark_admitted
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.outcome import with_outcome
from weirgate.session import tune
from weirgate.sources.tables import table
from weirgate.sources.wire import wire_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-31 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps, as the comparison engine shows them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        @wraps(run)
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(run(tune(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = tuned
        if sql is not None:
            ORACLES[name] = sql
        return tuned

    return register


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire events with ``seq``, the arrival number within an id."""
    return wire_events(spark, sf_dir).withColumn("seq", F.col("attempt").cast("bigint"))


def batched(df: DataFrame) -> DataFrame:
    """Requests of uneven size, some of them over the limit."""
    return df.withColumn(
        "batch_id", F.expr("CASE WHEN n % 3 = 0 THEN concat('a', n div 3600) ELSE concat('b', n div 1200) END")
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of the unvalidated path, as in FIXTURES.md section 4."""
    return with_outcome(mark_admitted(fill_defaults(wire(spark, sf_dir))))
