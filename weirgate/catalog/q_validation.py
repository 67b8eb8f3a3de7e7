"""Filters and rules: v01-v21."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.catalog.q_projections import BLANKS, blanked
from weirgate.catalog.registry import AS_OF, as_of, batched, events, query, wire
from weirgate.catalog.sql import BATCH, checked_sql, wire_sql
from weirgate.functions import rules
from weirgate.functions.text import threshold_colour
from weirgate.operators.batches import guard_batches, refused_requests
from weirgate.operators.listing import by_type, by_user, payload_contains, recent
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.validation import valid_rows, validate


def _rule_query(name: str, message, sql_condition: str, sql_message: str) -> None:
    """Rows that break one rule, with its message."""

    @query(name, wire_sql(f"SELECT event_id, attempt, {sql_message} AS error FROM wire WHERE {sql_condition}"))
    def run(spark, sf_dir):
        return (
            wire(spark, sf_dir)
            .select("event_id", "attempt", message().alias("error"))
            .filter("error IS NOT NULL")
        )


@query(
    "v01_event_id_required",
    wire_sql(
        "SELECT n, attempt, 'eventId is required' AS error FROM blanks "
        "WHERE event_id IS NULL OR regexp_full_match(event_id, '\\s*')",
        BLANKS,
    ),
)
def v01(spark, sf_dir):
    rows = blanked(spark, sf_dir).select("n", "attempt", rules.event_id_rule(F.col("event_id")).alias("error"))
    return rows.filter("error IS NOT NULL")


_rule_query(
    "v02_event_type_required",
    lambda: F.when(F.col("event_type").isNull(), rules.event_type_rule(F.col("event_type"))),
    "event_type IS NULL",
    "'eventType is required'",
)
_rule_query(
    "v03_event_type_format",
    lambda: F.when(F.col("event_type").isNotNull(), rules.event_type_rule(F.col("event_type"))),
    "NOT regexp_full_match(event_type, '[a-z][a-z0-9]*(?:\\.[a-z][a-z0-9_]*)+')",
    "'eventType must be lowercase dot-separated (e.g. user.login, analytics.page.view)'",
)


@query(
    "v04_user_id_required",
    wire_sql("""SELECT event_id, attempt, 'userId is required' AS error FROM (
  SELECT event_id, attempt, CASE n % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE user_id END AS user_id FROM wire)
WHERE user_id IS NULL OR regexp_full_match(user_id, '\\s*')"""),
)
def v04(spark, sf_dir):
    some = wire(spark, sf_dir).withColumn("user_id", F.expr("CASE n % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE user_id END"))
    return some.select("event_id", "attempt", rules.user_id_rule(F.col("user_id")).alias("error")).filter(
        F.col("error") == fv.USER_ID_REQUIRED
    )


_rule_query(
    "v05_user_id_format",
    lambda: rules.user_id_rule(F.col("user_id")),
    "NOT regexp_full_match(user_id, '[a-zA-Z0-9_@.-]{1,128}')",
    "'userId contains invalid characters (allowed: a-z A-Z 0-9 _ @ . -)'",
)


@query(
    "v06_timestamp_required",
    wire_sql("SELECT n, attempt, 'timestamp is required' AS error FROM blanks WHERE event_ts IS NULL", BLANKS),
)
def v06(spark, sf_dir):
    error = rules.timestamp_rule(F.col("event_ts"), F.col("received_at"))
    return blanked(spark, sf_dir).select("n", "attempt", error.alias("error")).filter(F.col("error") == fv.TIMESTAMP_REQUIRED)


_rule_query(
    "v07_timestamp_drift",
    lambda: rules.timestamp_rule(F.col("event_ts"), F.col("received_at")),
    "abs(datesub('hour', event_ts, received_at)) > 24",
    "'timestamp drift is ' || abs(datesub('hour', event_ts, received_at)) || ' hours — maximum allowed is 24 hours'",
)
_rule_query(
    "v08_data_is_object",
    lambda: rules.payload_rule(F.col("data"), F.json_object_keys("data")),
    "data IS NOT NULL AND json_type(data) NOT IN ('OBJECT', 'NULL')",
    "'data must be a JSON object'",
)

def _doc_size() -> str:
    """Fixed text of the record plus lengths, for a document carried as payload."""
    fixed = len("Event[eventId=, eventType=, userId=, timestamp=, data=, metadata=, correlationId=, source=, version=]")
    return f"""SELECT event_id, size_bytes,
  CASE WHEN size_bytes > 1048576 THEN 'event size ' || size_bytes || ' bytes exceeds maximum 1048576 bytes (1 MB)' END AS error
FROM (SELECT event_id, {fixed} + 2 * octet_length(encode(event_id)) + octet_length(encode('document.' || lang))
    + octet_length(encode(source)) + 20 + octet_length(encode(data)) + 4 + 3 + 3 AS size_bytes
  FROM (SELECT 'doc_' || doc_id AS event_id, lang, source, '{{"text":"' || repeat(replace(text, '"', ''), 10) || '"}}' AS data FROM documents))"""


@query("v09_event_size", _doc_size())
def v09(spark, sf_dir):
    """Documents, ten times over, as payloads: the long ones pass the size limit."""
    from weirgate.sources.tables import table

    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("event_id"),
        F.concat(F.lit("document."), F.col("lang")).alias("event_type"),
        F.col("source").alias("user_id"),
        F.lit("2024-01-31 00:00:00").cast("timestamp").alias("event_ts"),
        F.concat(F.lit('{"text":"'), F.repeat(F.replace("text", F.lit('"'), F.lit("")), F.lit(10)), F.lit('"}')).alias("data"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )
    size = rules.event_bytes(
        F.col("event_id"), F.col("event_type"), F.col("user_id"), F.col("event_ts"), F.col("data"),
        F.col("metadata"), F.col("event_id"), F.lit("api"), F.lit("1.0"),
    )
    sized = docs.select("event_id", size.cast("bigint").alias("size_bytes"))
    return sized.withColumn("error", rules.size_rule(F.col("size_bytes")))


def _business_query(name: str, types: tuple[str, ...]) -> None:
    listed = ", ".join(f"'{t}'" for t in types)
    tail = f"""SELECT event_id, attempt, unnest(errors) AS error FROM checked
WHERE len(base) = 0 AND event_type IN ({listed})"""

    @query(name, checked_sql(tail))
    def run(spark, sf_dir):
        checked = validate(fill_defaults(wire(spark, sf_dir)))
        mine = checked.select("event_id", "attempt", "event_type", F.explode("errors").alias("error"))
        return mine.filter(F.col("event_type").isin(*types) & F.col("error").startswith(F.concat(F.col("event_type"), F.lit(" requires")))).drop("event_type")


_business_query("v10_signup_fields", ("user.signup",))
_business_query("v11_transaction_fields", ("transaction.created", "transaction.completed", "transaction.failed"))
_business_query("v12_fraud_fields", ("fraud.detected",))
_business_query("v13_breach_fields", ("security.breach.attempted",))


@query(
    "v14_field_presence",
    wire_sql("""SELECT event_id, attempt, data IS NOT NULL AND json_type(data) <> 'NULL' AS has_payload,
  coalesce(list_contains(json_keys(data), 'email'), FALSE) AS has_email,
  coalesce(list_contains(json_keys(data), 'source'), FALSE) AS has_source,
  json_extract_string(data, '$.email') IS NOT NULL AS email_has_value FROM wire"""),
)
def v14(spark, sf_dir):
    """A key with an explicit null is present."""
    keys = F.json_object_keys("data")
    return wire(spark, sf_dir).select(
        "event_id", "attempt", rules.has_payload(F.col("data")).alias("has_payload"),
        F.coalesce(F.array_contains(keys, "email"), F.lit(False)).alias("has_email"),
        F.coalesce(F.array_contains(keys, "source"), F.lit(False)).alias("has_source"),
        F.get_json_object("data", "$.email").isNotNull().alias("email_has_value"),
    )


_KNOWN = ", ".join(f"'{t}'" for t in fv.KNOWN_TYPES)


@query(
    "v15_known_types",
    wire_sql(f"""SELECT event_type, coalesce(event_type IN ({_KNOWN}), FALSE) AS known, count(*) AS events
FROM wire GROUP BY 1, 2"""),
)
def v15(spark, sf_dir):
    return wire(spark, sf_dir).groupBy("event_type", rules.is_known_type(F.col("event_type")).alias("known")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query("v16_valid_rows", checked_sql("SELECT event_id, attempt, event_type FROM checked WHERE len(errors) = 0"))
def v16(spark, sf_dir):
    return valid_rows(validate(fill_defaults(wire(spark, sf_dir)))).select("event_id", "attempt", "event_type")


@query(
    "validate_errors",
    checked_sql("SELECT event_id, attempt, unnest(errors) AS error FROM checked"),
)
def validate_errors(spark, sf_dir):
    """All rules together, one row per message."""
    return validate(fill_defaults(wire(spark, sf_dir))).select("event_id", "attempt", F.explode("errors").alias("error"))


@query(
    "v17_batch_size_limit",
    wire_sql(f"""SELECT batch_id, 'Batch too large' AS error, 1000 AS max_size, count(*) AS received
FROM (SELECT {BATCH} FROM wire) GROUP BY batch_id HAVING count(*) > 1000"""),
)
def v17(spark, sf_dir):
    return guard_batches(batched(wire(spark, sf_dir))).rejected


@query(
    "v17_accepted_batches",
    wire_sql(f"""SELECT batch_id, event_id, attempt FROM (SELECT *, {BATCH} FROM wire)
WHERE batch_id NOT IN (SELECT batch_id FROM (SELECT {BATCH} FROM wire) GROUP BY batch_id HAVING count(*) > 1000)"""),
)
def v17_accepted(spark, sf_dir):
    return guard_batches(batched(wire(spark, sf_dir))).accepted.select("batch_id", "event_id", "attempt")


@query(
    "v18_annotations",
    wire_sql("""SELECT n, attempt, unnest([m FOR m IN [
    CASE WHEN event_id IS NULL OR regexp_full_match(event_id, '\\s*') THEN 'Event ID is required' END,
    CASE WHEN event_type IS NULL THEN 'Event type is required' END,
    CASE WHEN event_ts IS NULL THEN 'Timestamp is required' END] IF m IS NOT NULL]) AS error FROM blanks""", BLANKS),
)
def v18(spark, sf_dir):
    return validate(blanked(spark, sf_dir), "annotations").select("n", "attempt", F.explode("errors").alias("error"))


@query(
    "v18_request_rejected",
    wire_sql("""SELECT request, n, attempt FROM (SELECT n // 5 AS request, n, attempt,
  count(*) FILTER (WHERE event_id IS NULL OR regexp_full_match(event_id, '\\s*') OR event_type IS NULL OR event_ts IS NULL)
    OVER (PARTITION BY n // 5) AS bad FROM blanks) WHERE bad = 0""", BLANKS),
)
def v18_requests(spark, sf_dir):
    """Five events to a request; one that fails the annotations refuses all five."""
    checked = validate(blanked(spark, sf_dir), "annotations").withColumn("batch_id", F.expr("n div 5"))
    return refused_requests(checked).accepted.select(F.col("batch_id").alias("request"), "n", "attempt")


@query(
    "v19_access_paths",
    wire_sql("""SELECT 'type' AS path, event_id, attempt FROM wire WHERE event_type = 'transaction.failed'
UNION ALL SELECT 'user', event_id, attempt FROM wire WHERE user_id = 'user_8'
UNION ALL SELECT 'payload', event_id, attempt FROM wire WHERE json_extract_string(data, '$.ip') = '10.0.0.1'
  AND json_extract_string(data, '$.reason') = 'bruteforce'"""),
)
def v19(spark, sf_dir):
    rows = wire(spark, sf_dir)
    found = [
        ("type", by_type(rows, "transaction.failed")),
        ("user", by_user(rows, "user_8")),
        ("payload", payload_contains(rows, {"ip": "10.0.0.1", "reason": "bruteforce"})),
    ]
    parts = [df.select(F.lit(name).alias("path"), "event_id", "attempt") for name, df in found]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "v20_recent_range",
    f"""SELECT event_id, ts, event_type FROM events
WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 15 MINUTE AND ts <= TIMESTAMP '{AS_OF}'""",
)
def v20(spark, sf_dir):
    return recent(events(spark, sf_dir), as_of(), 15, at="ts").select("event_id", "ts", "event_type")


@query(
    "v21_threshold_colours",
    """SELECT event_type, count(*) / 1000.0 AS thousands,
  CASE WHEN count(*) / 1000.0 >= 80 THEN 'red' ELSE 'green' END AS throughput_colour,
  CASE WHEN round(avg(value), 6) >= 99.9 THEN 'red' ELSE 'green' END AS success_colour,
  CASE WHEN count(*) >= 100 THEN 'red' ELSE 'green' END AS total_colour
FROM events GROUP BY event_type""",
)
def v21(spark, sf_dir):
    counted = events(spark, sf_dir).groupBy("event_type").agg(
        (F.count(F.lit(1)) / F.lit(1000.0)).alias("thousands"), F.round(F.avg("value"), 6).alias("m"), F.count(F.lit(1)).alias("c")
    )
    red = fv.RED_THRESHOLDS
    return counted.select(
        "event_type", "thousands", threshold_colour(F.col("thousands"), red["throughput"]).alias("throughput_colour"),
        threshold_colour(F.col("m"), red["success_rate"]).alias("success_colour"),
        threshold_colour(F.col("c"), red["total"]).alias("total_colour"),
    )
