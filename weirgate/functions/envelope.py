"""Columns derived from the event envelope: category, severity, topic, key, label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.functions.text import stable_hash


def category(event_type: Column) -> Column:
    return F.split_part(event_type, F.lit("."), F.lit(1))


def is_critical(event_type: Column) -> Column:
    flag = F.lit(False)
    for prefix in fv.CRITICAL_PREFIXES:
        flag = flag | event_type.startswith(prefix)
    return flag


def topic_for(event_type: Column) -> Column:
    """Severity first, then category, then the raw topic. A null type has no topic."""
    name = F.when(event_type.isNull(), F.lit(None).cast("string"))
    name = name.when(is_critical(event_type), F.lit(fv.CRITICAL_TOPIC))
    for key, topic in fv.CATEGORY_TOPICS.items():
        name = name.when(category(event_type) == key, F.lit(topic))
    return name.otherwise(F.lit(fv.RAW_TOPIC))


def is_unroutable(event_type: Column) -> Column:
    """No type, or a type without any segment (only dots)."""
    return event_type.isNull() | event_type.rlike(r"\A\.+\z")


def dedup_key(event_id: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), event_id)


def chart_label(event_type: Column) -> Column:
    last = F.element_at(F.split(event_type, r"\."), -1)
    return F.replace(last, F.lit("_"), F.lit(" "))


def partition_for(topic: Column, key: Column) -> Column:
    """Same key, same partition of its topic."""
    counts = F.create_map(
        *[F.lit(x) for pair in fv.TOPIC_PARTITIONS.items() for x in pair]
    )
    return F.pmod(stable_hash(key), F.element_at(counts, topic).cast("bigint")).cast("int")


def headers(correlation_id: Column, event_type: Column, source: Column, version: Column) -> Column:
    """Record headers in order; absent ones are left out."""
    pairs = [
        ("correlationId", correlation_id),
        ("eventType", event_type),
        ("source", source),
        ("schemaVersion", version),
    ]
    none = F.array().cast("array<struct<key:string,value:binary>>")
    return F.concat(
        *[
            F.when(
                value.isNotNull(),
                F.array(F.struct(F.lit(name).alias("key"), F.encode(value, "UTF-8").alias("value"))),
            ).otherwise(none)
            for name, value in pairs
        ]
    )


def wire_value(
    event_id: Column,
    event_type: Column,
    user_id: Column,
    event_ts: Column,
    data: Column,
    metadata: Column,
    correlation_id: Column,
    source: Column,
    version: Column,
    omit_nulls: bool = True,
) -> Column:
    """The record value as JSON; the payload is embedded, not quoted."""
    body = F.struct(
        event_id.alias("eventId"),
        event_type.alias("eventType"),
        user_id.alias("userId"),
        F.date_format(event_ts, fv.TIMESTAMP_FORMAT).alias("timestamp"),
        # Text that is not JSON is kept as a string.
        F.coalesce(F.try_parse_json(data), data.cast("variant")).alias("data"),
        metadata.alias("metadata"),
        correlation_id.alias("correlationId"),
        source.alias("source"),
        version.alias("version"),
    )
    return F.to_json(body, {"ignoreNullFields": "true" if omit_nulls else "false"})
