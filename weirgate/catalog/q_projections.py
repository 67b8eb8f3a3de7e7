"""Projections and normalisation: p01-p15."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.catalog.registry import events, outcomes, query, wire
from weirgate.catalog.sql import BASE, TOPIC, outcome_sql, wire_sql
from weirgate.functions import envelope, text
from weirgate.operators.normalise import create_events, fill_defaults
from weirgate.operators.outcome import acknowledgements, error_rows, rejections
from weirgate.operators.validation import invalid_rows, validate
from weirgate.plans.ingest import route_counts
from weirgate.settings import DEFAULTS

BLANKS = """blanks AS (
  SELECT n, attempt, received_at, event_type, user_id, data, 'w' || (n % 7) AS batch_id, n * 10 + attempt AS seq,
    CASE n % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN chr(9) || ' ' ELSE event_id END AS event_id,
    CASE WHEN n % 5 = 0 THEN NULL ELSE event_ts END AS event_ts,
    CASE n % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE '2.0' END AS version,
    CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'mobile' END AS source,
    CASE n % 6 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'corr_' || n END AS correlation_id
  FROM wire
), filled AS (
  SELECT n, attempt, received_at, event_type, user_id, data, batch_id, seq,
    CASE WHEN n % 7 < 3 THEN sha256(batch_id || '|' || seq) ELSE event_id END AS event_id,
    coalesce(event_ts, received_at) AS event_ts,
    CASE WHEN n % 4 < 2 THEN '1.0' ELSE version END AS version,
    CASE WHEN n % 3 < 2 THEN 'api' ELSE source END AS source,
    CASE WHEN n % 6 < 2 THEN (CASE WHEN n % 7 < 3 THEN sha256(batch_id || '|' || seq) ELSE event_id END)
         ELSE correlation_id END AS correlation_id
  FROM blanks
)"""


def blanked(spark, sf_dir) -> DataFrame:
    """Wire events with blank fields where the defaults must step in."""
    return wire(spark, sf_dir).select(
        "n", "attempt", "received_at", "event_type", "user_id", "data",
        F.expr("concat('w', n % 7)").alias("batch_id"),
        F.expr("n * 10 + attempt").alias("seq"),
        F.expr("CASE n % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat(chr(9), ' ') ELSE event_id END").alias("event_id"),
        F.expr("CASE WHEN n % 5 = 0 THEN NULL ELSE event_ts END").alias("event_ts"),
        F.expr("CASE n % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE '2.0' END").alias("version"),
        F.expr("CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'mobile' END").alias("source"),
        F.expr("CASE n % 6 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE concat('corr_', n) END").alias("correlation_id"),
    )


def _default_query(name: str, column: str) -> None:
    @query(name, wire_sql(f"SELECT n, attempt, {column} FROM filled", BLANKS))
    def run(spark, sf_dir):
        return fill_defaults(blanked(spark, sf_dir)).select("n", "attempt", column)


_default_query("p01_event_id_default", "event_id")
_default_query("p02_timestamp_default", "event_ts")
_default_query("p03_version_default", "version")
_default_query("p04_source_default", "source")
_default_query("p05_correlation_default", "correlation_id")


@query(
    "p06_create_event",
    wire_sql("""SELECT n, attempt, sha256(attempt || '|' || n) AS event_id, event_type, user_id, data,
  received_at AS event_ts, '1.0' AS version, 'api' AS source, sha256(attempt || '|' || n) AS correlation_id FROM wire"""),
)
def p06(spark, sf_dir):
    bare = wire(spark, sf_dir).select("n", "attempt", "event_type", "user_id", "data", "received_at")
    return create_events(bare, identity=("attempt", "n")).select(
        "n", "attempt", "event_id", "event_type", "user_id", "data", "event_ts", "version", "source", "correlation_id"
    )


@query("p07_category", wire_sql("SELECT event_id, attempt, split_part(event_type, '.', 1) AS category FROM wire"))
def p07(spark, sf_dir):
    return wire(spark, sf_dir).select("event_id", "attempt", envelope.category(F.col("event_type")).alias("category"))


@query(
    "p08_critical_flag",
    wire_sql("""SELECT event_id, attempt, event_type LIKE 'error.%' OR event_type LIKE 'security.%'
  OR event_type LIKE 'fraud.%' AS critical FROM wire WHERE event_type IS NOT NULL"""),
)
def p08(spark, sf_dir):
    typed = wire(spark, sf_dir).filter("event_type IS NOT NULL")
    return typed.select("event_id", "attempt", envelope.is_critical(F.col("event_type")).alias("critical"))


@query("p09_topic_routing", wire_sql(f"SELECT event_id, attempt, {TOPIC} AS topic FROM wire"))
def p09(spark, sf_dir):
    return wire(spark, sf_dir).select("event_id", "attempt", envelope.topic_for(F.col("event_type")).alias("topic"))


@query(
    "p09_route_counts",
    wire_sql(f"SELECT {TOPIC} AS topic, count(*) AS events FROM wire WHERE event_type IS NOT NULL GROUP BY 1"),
)
def p09_counts(spark, sf_dir):
    return route_counts(wire(spark, sf_dir))


@query("p10_dedup_key", wire_sql("SELECT event_id, attempt, 'dedup:' || event_id AS dedup_key FROM wire"))
def p10(spark, sf_dir):
    key = envelope.dedup_key(F.col("event_id"), DEFAULTS.dedup_key_prefix)
    return wire(spark, sf_dir).select("event_id", "attempt", key.alias("dedup_key"))


@query(
    "p11_acceptance_rows",
    outcome_sql("""SELECT event_id, 'accepted' AS status, 'Event queued for processing' AS message,
  event_id AS correlation_id FROM outcomes WHERE outcome <> 'failed'"""),
)
def p11(spark, sf_dir):
    return acknowledgements(outcomes(spark, sf_dir))


P12_SQL = """SELECT 'Validation failed' AS error, array_to_string(errors, '; ') AS details, event_id AS correlation_id
FROM checked WHERE len(errors) > 0"""


def p12(spark, sf_dir):
    checked = validate(fill_defaults(wire(spark, sf_dir)))
    return rejections(checked).withColumn("details", F.concat_ws("; ", "details"))


def p13(spark, sf_dir):
    checked = validate(fill_defaults(wire(spark, sf_dir)))
    invalid = error_rows(invalid_rows(checked), 400, F.lit(fv.VALIDATION_FAILED), F.col("errors"))
    failed = outcomes(spark, sf_dir).filter("outcome = 'failed'")
    broken = error_rows(failed, 500, F.lit(fv.INGESTION_FAILED), F.array().cast("array<string>"))
    return invalid.unionByName(broken).withColumn(
        "details", F.when(F.col("details").isNotNull(), F.concat_ws("; ", "details"))
    )


def _register_rejects() -> None:
    from weirgate.catalog.sql import ERRORS, _marks, checked_sql

    query("p12_rejection_rows", checked_sql(P12_SQL))(p12)
    both = "WITH RECURSIVE " + ", ".join([BASE, ERRORS, _marks("wire")])
    query(
        "p13_error_rows",
        both + """
SELECT event_id, 400 AS status, 'Bad Request' AS error, 'Validation failed' AS message,
  array_to_string(errors, '; ') AS details, received_at AS timestamp FROM checked WHERE len(errors) > 0
UNION ALL
SELECT event_id, 500, 'Internal Server Error', 'Event ingestion failed — event sent to dead-letter queue',
  CAST(NULL AS VARCHAR), received_at FROM outcomes WHERE outcome = 'failed'""",
    )(p13)


_register_rejects()


@query(
    "p14_chart_labels",
    outcome_sql("""SELECT event_type AS full_name, replace(split_part(event_type, '.', -1), '_', ' ') AS name, count(*) AS value
FROM outcomes WHERE outcome = 'processed' GROUP BY event_type"""),
)
def p14(spark, sf_dir):
    from weirgate.operators.totals import processed_by_type

    return processed_by_type(outcomes(spark, sf_dir)).select(
        F.col("event_type").alias("full_name"), envelope.chart_label(F.col("event_type")).alias("name"),
        F.col("events").alias("value"),
    )


@query(
    "p15_number_display",
    """SELECT event_type, printf('%.1fK/s', count(*) / 1000.0) AS rate_text,
  format('{:,}', count(*)) AS count_text, printf('%.2f%%', count(*) * 100.0 / (SELECT count(*) FROM events)) AS percent_text
FROM events GROUP BY event_type""",
)
def p15(spark, sf_dir):
    from pyspark.sql.window import Window as W

    counted = events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("c"))
    # Over one row per type, not over events.
    share = F.col("c") * F.lit(100.0) / F.sum("c").over(W.partitionBy(F.lit(1)))
    return counted.select(
        "event_type", text.thousands_rate(F.col("c")).alias("rate_text"),
        text.grouped_number(F.col("c")).alias("count_text"), text.percent_text(share).alias("percent_text"),
    )
