"""JSON events: strict decoding, single events, batches and streams.

The payload is read as ``variant`` and rendered back, so a string that looks like an object
stays a string. The timestamp is read as text and parsed with the one wire format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate import fixed_values as fv
from weirgate.operators.normalise import numbered_lines
from weirgate.settings import DEFAULTS, Settings

CORRUPT = "_corrupt_record"

ENVELOPE = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("data", T.VariantType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("correlationId", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("version", T.StringType()),
        # Arrival clock when the transport recorded one.
        T.StructField("receivedAt", T.TimestampType()),
    ]
)
ENVELOPE_OR_CORRUPT = T.StructType([*ENVELOPE.fields, T.StructField(CORRUPT, T.StringType())])


def _event_columns(e: str, arrived: Column, recorded: bool) -> list[Column]:
    """``recorded``: the body's own arrival clock counts. Only for replays of recorded traffic; a
    client could otherwise choose when its event arrived."""

    def field(name: str) -> Column:
        return F.col(f"{e}{name}")

    return [
        field("eventId").alias("event_id"),
        field("eventType").alias("event_type"),
        field("userId").alias("user_id"),
        F.try_to_timestamp(field("timestamp"), F.lit(fv.TIMESTAMP_FORMAT)).alias("event_ts"),
        F.to_json(field("data")).alias("data"),
        field("metadata").alias("metadata"),
        field("correlationId").alias("correlation_id"),
        field("source").alias("source"),
        field("version").alias("version"),
        (F.coalesce(field("receivedAt"), arrived) if recorded else arrived).alias("received_at"),
    ]


def _bad_timestamp(e: str) -> Column:
    text = F.col(f"{e}timestamp")
    return text.isNotNull() & F.try_to_timestamp(text, F.lit(fv.TIMESTAMP_FORMAT)).isNull()


def malformed(e: str = "") -> Column:
    """Why the row cannot be decoded, or null."""
    return F.when(F.col(f"{e}{CORRUPT}").isNotNull(), F.lit("json")).when(_bad_timestamp(e), F.lit("timestamp"))


def decode_lines(
    lines: DataFrame, body: str = "value", arrived: Column | None = None, recorded: bool = False
) -> DataFrame:
    """One event per text row, strict. ``malformed`` is null for the rows that decode."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.withColumn("_e", F.from_json(F.col(body), ENVELOPE_OR_CORRUPT, options))
    clock = arrived if arrived is not None else F.current_timestamp()
    kept = [F.col(c) for c in lines.columns]
    return parsed.select(*kept, *_event_columns("_e.", clock, recorded), malformed("_e.").alias("malformed"))


def decode_batches(
    requests: DataFrame, body: str = "body", arrived: Column | None = None, recorded: bool = False
) -> DataFrame:
    """One request body (a JSON array) per row, exploded to events.

    A body that is not an array of events, or one bad timestamp in it, makes the whole request
    malformed; it then keeps one row without an event.
    """
    clock = arrived if arrived is not None else F.current_timestamp()
    is_array = F.col(body).rlike(r"\A\s*\[")
    parsed = requests.withColumn(
        "_all", F.when(is_array, F.from_json(F.col(body), T.ArrayType(ENVELOPE), {"mode": "PERMISSIVE"}))
    )
    bad_clock = F.exists(
        "_all",
        lambda x: x["timestamp"].isNotNull()
        & F.try_to_timestamp(x["timestamp"], F.lit(fv.TIMESTAMP_FORMAT)).isNull(),
    )
    judged = parsed.withColumn(
        "malformed", F.when(F.col("_all").isNull(), F.lit("json")).when(bad_clock, F.lit("timestamp"))
    )
    kept = [F.col(c) for c in requests.columns if c != body]
    opened = judged.select(
        *kept, "malformed", F.size("_all").alias("batch_size"),
        F.posexplode_outer(F.when(F.col("malformed").isNull(), F.col("_all"))).alias("position", "_e"),
    )
    return opened.select(*kept, "malformed", "batch_size", "position", *_event_columns("_e.", clock, recorded))


def _line_events(raw: DataFrame, entry: str, recorded: bool) -> DataFrame:
    """Events of text lines; ``batch_id`` is the file and ``line`` a hash of the text, which no split changes."""
    lines = raw.filter(F.trim("value") != "").select(
        "value", F.col("_metadata.file_path").alias("batch_id"), F.col("_metadata.file_modification_time").alias("_arrived")
    )
    decoded = decode_lines(lines, arrived=F.col("_arrived"), recorded=recorded)
    return decoded.withColumns({"entry": F.lit(entry), "line": F.xxhash64("value")}).drop("value", "_arrived")


def read_events(spark: SparkSession, path: str, entry: str = "single", recorded: bool = False) -> DataFrame:
    """Newline-delimited events at rest. ``seq`` follows the input splits, ids that are made up do not."""
    return numbered_lines(_line_events(spark.read.text(path), entry, recorded))


def read_batch_files(
    spark: SparkSession, path: str, recorded: bool = False, settings: Settings = DEFAULTS
) -> DataFrame:
    """One request per file, each a JSON array over any number of lines.

    A file longer than ``max_request_bytes`` is one row that is malformed by ``size``: the length is known
    from the listing, so such a body is never opened and the other requests go on.
    """
    files = spark.read.format("binaryFile").load(path)
    known = [F.col("_metadata.file_path").alias("batch_id"), F.col("modificationTime").alias("_arrived")]
    fits = files.filter(F.col("length") <= settings.max_request_bytes).select(F.col("content").cast("string").alias("body"), *known)
    decoded = decode_batches(fits, arrived=F.col("_arrived"), recorded=recorded).drop("_arrived")
    refused = files.filter(F.col("length") > settings.max_request_bytes).select(*known)
    told = {"malformed": F.lit("size"), "received_at": F.col("_arrived")}
    empty = {f.name: F.lit(None).cast(f.dataType) for f in decoded.schema if f.name not in ("batch_id", *told)}
    return decoded.unionByName(refused.withColumns({**empty, **told}).drop("_arrived")).withColumns(
        {"entry": F.lit("batch"), "seq": F.col("position").cast("bigint")}
    )


def stream_events(spark: SparkSession, path: str, max_files: int = 64, recorded: bool = False) -> DataFrame:
    """Newline-delimited events as they land in a folder."""
    return _line_events(spark.readStream.option("maxFilesPerTrigger", max_files).text(path), "stream", recorded)
