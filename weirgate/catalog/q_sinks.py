"""Sinks: k01-k11, written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.catalog.registry import outcomes, query, wire
from weirgate.catalog.sql import TOPIC, json_text, millis, outcome_sql, stable_hash, wire_sql
from weirgate.functions.envelope import headers, partition_for, topic_for, wire_value
from weirgate.operators.normalise import fill_defaults
from weirgate.session import cut_lineage, scratch_path, tune_streaming
from weirgate.sinks import tables, topics
from weirgate.sinks.commits import CommitLog
from weirgate.sources.tables import table
from weirgate import fixed_values as fv

_VALUE = f"""'{{"eventId":"' || event_id || '",' || coalesce('"eventType":"' || event_type || '",', '') || '"userId":"' || user_id
  || '","timestamp":"' || strftime({millis('event_ts')}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z",'
  || coalesce('"data":' || {json_text()} || ',', '') || '"correlationId":"' || event_id || '","source":"api","version":"1.0"}}'"""
_COUNTS = "CASE {t} WHEN 'events.raw' THEN 10 WHEN 'events.system' THEN 3 WHEN 'events.critical' THEN 3 WHEN 'events.dlq' THEN 1 ELSE 5 END"


@query(
    "k01_publish_topics",
    outcome_sql(f"""SELECT routed AS topic, CAST({stable_hash('user_id')} % {_COUNTS.format(t='routed')} AS INTEGER) AS partition,
  user_id AS key, {_VALUE} AS value FROM outcomes WHERE outcome = 'processed'"""),
)
def k01(spark, sf_dir):
    path = scratch_path(spark, "k01")
    # Stored first, as the jobs do: finding the key ranges reads the rows once more.
    topics.publish(topics.published_records(cut_lineage(outcomes(spark, sf_dir))), path)
    return topics.delivered(spark, path).select("topic", "partition", "key", "value")


@query(
    "k02_publish_sync",
    outcome_sql("SELECT routed AS topic, count(*) AS delivered FROM outcomes WHERE outcome = 'processed' GROUP BY 1"),
)
def k02(spark, sf_dir):
    return topics.publish_sync(topics.published_records(cut_lineage(outcomes(spark, sf_dir))), scratch_path(spark, "k02"))


@query("k03_value_encoding", wire_sql(f"SELECT event_id, attempt, {_VALUE} AS value FROM wire"))
def k03(spark, sf_dir):
    full = fill_defaults(wire(spark, sf_dir))
    names = ("event_id", "event_type", "user_id", "event_ts", "data", "metadata", "correlation_id", "source", "version")
    return full.select("event_id", "attempt", wire_value(*[F.col(n) for n in names]).alias("value"))


@query(
    "k04_headers",
    wire_sql("""SELECT event_id, attempt, h.key AS name, h.value AS value FROM (SELECT event_id, attempt, unnest([
  {'key': 'correlationId', 'value': event_id}, {'key': 'eventType', 'value': event_type},
  {'key': 'source', 'value': 'api'}, {'key': 'schemaVersion', 'value': '1.0'}]) AS h FROM wire) WHERE h.value IS NOT NULL"""),
)
def k04(spark, sf_dir):
    full = fill_defaults(wire(spark, sf_dir))
    h = F.explode(headers(F.col("correlation_id"), F.col("event_type"), F.col("source"), F.col("version"))).alias("h")
    return full.select("event_id", "attempt", h).select(
        "event_id", "attempt", F.col("h.key").alias("name"), F.decode("h.value", "UTF-8").alias("value")
    )


@query(
    "k05_keyed_partitions",
    wire_sql(f"""SELECT topic, CAST({stable_hash('user_id')} % {_COUNTS.format(t='topic')} AS INTEGER) AS partition,
  count(*) AS events, count(DISTINCT user_id) AS keys FROM (SELECT *, {TOPIC} AS topic FROM wire WHERE event_type IS NOT NULL) GROUP BY 1, 2"""),
)
def k05(spark, sf_dir):
    routed = wire(spark, sf_dir).filter("event_type IS NOT NULL").withColumn("topic", topic_for(F.col("event_type")))
    placed = routed.withColumn("partition", partition_for(F.col("topic"), F.col("user_id")))
    return placed.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("keys"))


@query(
    "k06_dead_letter_publish",
    outcome_sql(f"SELECT 'events.dlq' AS topic, event_id AS key, {_VALUE} AS value FROM outcomes WHERE outcome = 'failed'"),
)
def k06(spark, sf_dir):
    path = scratch_path(spark, "k06")
    topics.publish(topics.dead_letter_records(cut_lineage(outcomes(spark, sf_dir))), path)
    return topics.delivered(spark, path).select("topic", "key", "value")


@query(
    "k07_events_table",
    outcome_sql("""SELECT event_id, event_type, user_id, 'api' AS source, '1.0' AS version, event_id AS correlation_id, data,
  event_ts, received_at AS created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY received_at, attempt) AS rn FROM outcomes WHERE outcome = 'processed')
WHERE rn = 1"""),
)
def k07(spark, sf_dir):
    """Two inserts; the second one repeats ids of the first."""
    log = CommitLog(spark, scratch_path(spark, "k07"))
    done = outcomes(spark, sf_dir)
    half = F.lit("2024-01-16 00:00:00").cast("timestamp")
    for part in (done.filter(F.col("received_at") < half), done.filter(F.col("received_at") >= half)):
        log.retried(lambda run, part=part: tables.insert_events(run, tables.event_rows(part)))
    return log.read("events", tables.EVENTS).drop("metadata", "run")


@query(
    "k08_dead_letter_table",
    outcome_sql(f"""SELECT event_id, event_type, user_id, {_VALUE} AS raw_payload, 'event type is null' AS error_reason, 0 AS retry_count,
  received_at AS created_at FROM outcomes WHERE outcome = 'failed'"""),
)
def k08(spark, sf_dir):
    path = scratch_path(spark, "k08")
    tables.write_dead_letters(tables.dead_letter_rows(outcomes(spark, sf_dir)), path)
    return tables.read_table(spark, path, tables.DEAD_LETTERS).drop("last_retried_at")


@query(
    "k09_hourly_upsert",
    outcome_sql("""SELECT date_trunc('hour', received_at) AS hour_bucket, event_type, count(*) AS total_count,
  count(*) FILTER (WHERE outcome = 'processed') AS success_count, count(*) FILTER (WHERE outcome = 'failed') AS failure_count
FROM outcomes WHERE event_type IS NOT NULL GROUP BY 1, 2"""),
)
def k09(spark, sf_dir):
    """Two increments, split inside the hours, add up to the rollup of the whole."""
    log = CommitLog(spark, scratch_path(spark, "k09"))
    done = outcomes(spark, sf_dir)
    for part in (done.filter("minute(received_at) < 30"), done.filter("minute(received_at) >= 30")):
        log.retried(lambda run, part=part: tables.upsert_hourly(run, part))
    return tables.current_hourly(log)


@query(
    "k10_stats_push",
    outcome_sql("""SELECT s.*, b.event_type, b.events FROM (
  SELECT CAST(0 AS BIGINT) AS sequence, count(*) AS total_received, count(*) FILTER (WHERE outcome = 'processed') AS total_processed,
    count(*) FILTER (WHERE outcome = 'failed') AS total_failed,
    floor(count(*) FILTER (WHERE outcome = 'processed') * 10000.0 / count(*) + 0.5) / 100 AS success_rate FROM outcomes) s,
  (SELECT event_type, count(*) AS events FROM outcomes WHERE outcome = 'processed' GROUP BY event_type) b"""),
)
def k10(spark, sf_dir):
    """The snapshots a stream over the outcomes pushes."""
    from weirgate.streaming.stats import start_stats

    tune_streaming(spark)
    source, pushed, marks = (scratch_path(spark, f"k10-{x}") for x in ("in", "out", "checkpoint"))
    done = outcomes(spark, sf_dir).select("event_type", "outcome", "received_at")
    done.write.parquet(source)
    start_stats(spark.readStream.schema(done.schema).parquet(source), pushed, marks, every_millis=None).awaitTermination()
    return spark.read.parquet(pushed).select(
        "sequence", "total_received", "total_processed", "total_failed", "success_rate",
        F.explode("events_by_type").alias("event_type", "events"),
    )


@query(
    "k11_column_limits",
    """SELECT doc_id, array_to_string([m FOR m IN [CASE WHEN length('doc.' || lang) > 100 THEN 'event_type' END,
  CASE WHEN length(text) > 128 THEN 'user_id' END, CASE WHEN length(split_part(text, '.', 1)) > 100 THEN 'source' END,
  CASE WHEN length(source) > 20 THEN 'version' END, CASE WHEN length(text) > 255 THEN 'correlation_id' END] IF m IS NOT NULL], ',') AS too_long
FROM documents WHERE length(text) > 128 OR length(split_part(text, '.', 1)) > 100 OR length(source) > 20 OR length(text) > 255""",
)
def k11(spark, sf_dir):
    """Documents forced into the columns of the events table."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("event_id"), F.concat(F.lit("doc."), "lang").alias("event_type"),
        F.col("text").alias("user_id"), F.split_part("text", F.lit("."), F.lit(1)).alias("source"),
        F.col("source").alias("version"), F.col("text").alias("correlation_id"),
    )
    return tables.over_limits(docs, fv.EVENT_COLUMN_LIMITS).select("doc_id", F.concat_ws(",", "too_long").alias("too_long"))


_NARROW = {"event_id": 7, "event_type": 20}


@query(
    "k11_quarantine",
    outcome_sql("""SELECT event_id, CASE WHEN length(event_id) > 7 OR length(event_type) > 20 THEN 'quarantine' ELSE 'events' END AS stored
FROM (SELECT DISTINCT ON (event_id) * FROM outcomes WHERE outcome = 'processed' ORDER BY event_id, received_at, attempt)"""),
)
def k11_quarantine(spark, sf_dir):
    """With narrow columns, every processed event is in the table or in quarantine."""
    log = CommitLog(spark, scratch_path(spark, "k11"))
    rows = tables.event_rows(outcomes(spark, sf_dir))
    log.retried(lambda run: tables.insert_events(run, rows, _NARROW))
    kept = log.read("events", tables.EVENTS).select("event_id", F.lit("events").alias("stored"))
    return kept.unionByName(tables.quarantined(rows, _NARROW).select("event_id", F.lit("quarantine").alias("stored")))
