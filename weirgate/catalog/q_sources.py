"""Sources: s01-s04."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.catalog.registry import batched, query, wire
from weirgate.catalog.sql import BATCH, checked_sql, json_text, millis, wire_sql
from weirgate.operators.batches import malformed_requests
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.validation import valid_rows, validate
from weirgate.session import scratch_path, tune_streaming
from weirgate.settings import DEFAULTS
from weirgate.sources.json_events import decode_batches, decode_lines, read_batch_files, read_events, stream_events


def wire_json(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Wire events as JSON text, one per row, with the recorded arrival clock."""
    body = F.struct(
        F.col("event_id").alias("eventId"), F.col("event_type").alias("eventType"), F.col("user_id").alias("userId"),
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.parse_json("data").alias("data"),
        F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("receivedAt"),
    )
    return df.select(*extra, F.to_json(body).alias("value"))


_EVENT_SQL = f"event_id, event_type, user_id, {millis('event_ts')} AS event_ts, {json_text()} AS data, received_at"
_EVENT = ("event_id", "event_type", "user_id", "event_ts", "data", "received_at")


@query("s01_single_events", wire_sql(f"SELECT {_EVENT_SQL}, 'single' AS entry FROM wire"))
def s01(spark, sf_dir):
    path = scratch_path(spark, "s01")
    wire_json(wire(spark, sf_dir)).write.text(path)
    return read_events(spark, path, recorded=True).filter("malformed IS NULL").select(*_EVENT, "entry")


@query(
    "s02_batch_events",
    wire_sql(f"""SELECT batch_id, {_EVENT_SQL}, CAST(count(*) OVER (PARTITION BY batch_id) AS INTEGER) AS batch_size
FROM (SELECT *, {BATCH} FROM wire)"""),
)
def s02(spark, sf_dir):
    """One request body per line, decoded to its events."""
    lines = wire_json(batched(wire(spark, sf_dir)), ("batch_id",))
    bodies = lines.groupBy("batch_id").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("value")), F.lit("]")).alias("body"))
    return decode_batches(bodies, recorded=True).filter("malformed IS NULL").select("batch_id", *_EVENT, "batch_size")


@query(
    "s02_batch_files",
    wire_sql(f"SELECT {_EVENT_SQL}, 'batch' AS entry FROM wire"),
)
def s02_files(spark, sf_dir):
    """One request per file."""
    path = scratch_path(spark, "s02")
    lines = wire_json(batched(wire(spark, sf_dir)), ("batch_id",))
    bodies = lines.groupBy("batch_id").agg(F.concat(F.lit("["), F.concat_ws(",\n", F.collect_list("value")), F.lit("]")).alias("body"))
    bodies.write.partitionBy("batch_id").text(path)
    return read_batch_files(spark, f"{path}/*", recorded=True).filter("malformed IS NULL").select(*_EVENT, "entry")


@query(
    "s02_request_sizes",
    wire_sql(f"""SELECT batch_id AS request, CASE WHEN bytes > 40000 THEN 'size' ELSE 'none' END AS cause,
  CASE WHEN bytes > 40000 THEN 0 ELSE events END AS events FROM (
  SELECT batch_id, count(*) AS events, 2 + sum(length(line) + 1) AS bytes FROM (SELECT batch_id,
    '{{"eventId":"' || event_id || '",' || coalesce('"eventType":"' || event_type || '",', '') || '"userId":"' || user_id
    || '","timestamp":"' || strftime({millis('event_ts')}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"' || coalesce(',"data":' || {json_text()}, '')
    || ',"receivedAt":"' || strftime(received_at, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"}}' AS line
    FROM (SELECT *, {BATCH} FROM wire)) GROUP BY batch_id)"""),
)
def s02_sizes(spark, sf_dir):
    """Requests over 40,000 bytes are refused by the length of their file, the others are read."""
    path = scratch_path(spark, "s02s")
    lines = wire_json(batched(wire(spark, sf_dir)), ("batch_id",))
    bodies = lines.groupBy("batch_id").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("value")), F.lit("]")).alias("body"))
    bodies.write.partitionBy("batch_id").text(path)
    rows = read_batch_files(spark, f"{path}/*", settings=replace(DEFAULTS, max_request_bytes=40_000))
    request = F.regexp_extract("batch_id", "batch_id=([^/]*)", 1).alias("request")
    return rows.groupBy(request, F.coalesce("malformed", F.lit("none")).alias("cause")).agg(F.count("event_id").alias("events"))


@query("s03_stream_events", checked_sql(f"SELECT {_EVENT_SQL} FROM checked WHERE len(errors) = 0"))
def s03(spark, sf_dir):
    """Validated rows of the stream, as written by it."""
    tune_streaming(spark)
    source, out, marks = (scratch_path(spark, f"s03-{x}") for x in ("in", "out", "checkpoint"))
    # The fixture's clock has microseconds; the wire has milliseconds.
    wire_json(wire(spark, sf_dir)).write.text(source)
    rows = stream_events(spark, source, recorded=True).filter("malformed IS NULL")
    good = valid_rows(validate(fill_defaults(rows)))
    run = (
        good.select(*_EVENT).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", marks).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.parquet(out)


@query(
    "s04_strict_decode",
    wire_sql("""SELECT coalesce(cause, 'none') AS cause, count(*) AS lines FROM (
  SELECT CASE WHEN n % 53 = 0 THEN 'json' WHEN n % 59 = 0 THEN 'timestamp' END AS cause FROM wire) GROUP BY 1"""),
)
def s04(spark, sf_dir):
    """Some lines are cut in half, some have no milliseconds."""
    lines = wire_json(wire(spark, sf_dir), ("n",)).withColumn(
        "value",
        F.expr(
            "CASE WHEN n % 53 = 0 THEN substr(value, 1, length(value) - 5) "
            "WHEN n % 59 = 0 THEN regexp_replace(value, '(\"timestamp\":\"[^\"]*)\\\\.[0-9]{3}Z', '$1Z') ELSE value END"
        ),
    )
    return decode_lines(lines).groupBy(F.coalesce("malformed", F.lit("none")).alias("cause")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s04_quarantine",
    wire_sql("""SELECT 400 AS status, 'Malformed JSON request body' AS message, 'json' AS cause, received_at AS timestamp
FROM wire WHERE n % 53 = 0"""),
)
def s04_quarantine(spark, sf_dir):
    lines = wire_json(wire(spark, sf_dir), ("n", "received_at")).withColumn(
        "value", F.expr("CASE WHEN n % 53 = 0 THEN substr(value, 1, length(value) - 5) ELSE value END")
    )
    decoded = decode_lines(lines.withColumnRenamed("received_at", "arrived_at"), arrived=F.col("arrived_at"))
    return malformed_requests(decoded).select("status", "message", "cause", "timestamp")
