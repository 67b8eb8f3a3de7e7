"""Validation rules as columns that hold a message, or null when the rule holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.functions.text import is_blank, matches_whole
from weirgate.functions.timeaxis import instant
from weirgate.settings import DEFAULTS, Settings


def event_id_rule(event_id: Column) -> Column:
    return F.when(is_blank(event_id), F.lit(fv.EVENT_ID_REQUIRED))


def event_type_rule(event_type: Column) -> Column:
    # The good case first: one pattern per good row.
    return (
        F.when(matches_whole(event_type, fv.EVENT_TYPE_PATTERN), F.lit(None).cast("string"))
        .when(is_blank(event_type), F.lit(fv.EVENT_TYPE_REQUIRED))
        .otherwise(F.lit(fv.EVENT_TYPE_FORMAT))
    )


def user_id_rule(user_id: Column) -> Column:
    return (
        F.when(matches_whole(user_id, fv.USER_ID_PATTERN), F.lit(None).cast("string"))
        .when(is_blank(user_id), F.lit(fv.USER_ID_REQUIRED))
        .otherwise(F.lit(fv.USER_ID_FORMAT))
    )


def drift_hours(event_ts: Column, received_at: Column) -> Column:
    """Whole hours between the two instants, truncated, without sign."""
    return F.abs(F.timestamp_diff("HOUR", instant(event_ts), instant(received_at)))


def timestamp_rule(event_ts: Column, received_at: Column, limit: int = fv.MAX_DRIFT_HOURS) -> Column:
    hours = drift_hours(event_ts, received_at)
    return F.when(event_ts.isNull(), F.lit(fv.TIMESTAMP_REQUIRED)).when(
        hours > limit, F.format_string(fv.DRIFT_MESSAGE, hours, F.lit(limit))
    )


def has_payload(data: Column) -> Column:
    """False for an absent payload and for a JSON null."""
    return data.isNotNull() & (F.trim(data) != "null")


def payload_rule(data: Column, keys: Column) -> Column:
    return F.when(has_payload(data) & keys.isNull(), F.lit(fv.DATA_NOT_OBJECT))


def instant_length(value: Column) -> Column:
    """Length of the ISO text, which has as many fraction digits (0, 3 or 6) as it needs."""
    at = F.unix_micros(instant(value))
    return F.when(value.isNull(), F.lit(4)).when(at % 1_000_000 == 0, F.lit(20)).when(
        at % 1_000 == 0, F.lit(24)
    ).otherwise(F.lit(27))


def metadata_length(metadata: Column) -> Column:
    """Length of ``{key=value, ...}``, or of ``null``."""
    pairs = F.transform(
        F.map_entries(metadata),
        lambda e: F.octet_length(e["key"]) + 1 + F.coalesce(F.octet_length(e["value"]), F.lit(4)),
    )
    entries = F.aggregate(pairs, F.lit(0), lambda a, n: a + n)
    text = 2 + entries + 2 * F.greatest(F.size(metadata) - 1, F.lit(0))
    return F.when(metadata.isNull(), F.lit(4)).otherwise(text)


def event_bytes(
    event_id: Column,
    event_type: Column,
    user_id: Column,
    event_ts: Column,
    data: Column,
    metadata: Column,
    correlation_id: Column,
    source: Column,
    version: Column,
    map_length: Column | None = None,
) -> Column:
    """UTF-8 size of the record's text form ``Event[name=value, ...]``.

    Only the lengths are added up, so no copy of a large payload is made. ``map_length`` may
    carry the length of the metadata text when it was computed before.
    """
    if map_length is None:
        map_length = metadata_length(metadata)
    labels = (
        "Event[eventId=, eventType=, userId=, timestamp=, data=, metadata=, "
        "correlationId=, source=, version=]"
    )
    total = F.lit(len(labels)) + instant_length(event_ts) + map_length
    for text in (event_id, event_type, user_id, data, correlation_id, source, version):
        total = total + F.coalesce(F.octet_length(text), F.lit(4))
    return total


def size_rule(size: Column, limit: int = fv.MAX_EVENT_BYTES) -> Column:
    return F.when(size > limit, F.format_string(fv.SIZE_MESSAGE, size, F.lit(limit)))


def is_known_type(event_type: Column) -> Column:
    return F.coalesce(event_type.isin(*fv.KNOWN_TYPES), F.lit(False))


def collected(*messages: Column) -> Column:
    """The messages that are not null, in order. Plain expressions, so it compiles to Java."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(m.isNotNull(), F.array(m)).otherwise(none) for m in messages])


def business_rules(event_type: Column, data: Column, keys: Column) -> Column:
    """Array of messages for the payload fields the event type needs."""
    none = F.array().cast("array<string>")
    found = F.when(~has_payload(data), F.array(F.concat(event_type, F.lit(" requires a data payload"))))
    for fields in dict.fromkeys(f for f in fv.KNOWN_TYPES.values() if f):
        types = [t for t, f in fv.KNOWN_TYPES.items() if f == fields]
        missing = [
            F.when(~F.array_contains(keys, f), F.concat(event_type, F.lit(f" requires data.{f}"))) for f in fields
        ]
        found = found.when(event_type.isin(*types), collected(*missing))
    needing = [t for t, f in fv.KNOWN_TYPES.items() if f]
    return F.when(event_type.isin(*needing), found).otherwise(none)


def annotation_rules(event_id: Column, event_type: Column, user_id: Column, event_ts: Column) -> Column:
    values = {
        "event_id": is_blank(event_id),
        "event_type": is_blank(event_type),
        "user_id": is_blank(user_id),
        "event_ts": event_ts.isNull(),
    }
    return collected(*[F.when(values[name], F.lit(text)) for name, text in fv.FIELD_ANNOTATIONS.items()])


def base_rules(columns: dict[str, Column], keys: Column, size: Column, settings: Settings = DEFAULTS) -> Column:
    """All field rules in order; none hides another."""
    return collected(
        event_id_rule(columns["event_id"]),
        event_type_rule(columns["event_type"]),
        user_id_rule(columns["user_id"]),
        timestamp_rule(columns["event_ts"], columns["received_at"], settings.max_drift_hours),
        payload_rule(columns["data"], keys),
        size_rule(size, settings.max_event_bytes),
    )
