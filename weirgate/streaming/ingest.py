"""Continuous ingest: one stream, all outputs of a micro-batch in one commit.

A micro-batch writes its outputs as parts that no reader sees and commits them together, under its
number; a replay finds the number done. The batch job and the dead-letter rounds use the same log, so
all of them can share a folder. The seen-set is the table of admissions, by day and by a hash bucket of
the id: a micro-batch reads the days within reach and the buckets its ids fall in, and small parts are
merged as they pile up.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirgate.functions.timeaxis import shift
from weirgate.operators.batches import malformed_requests, well_formed
from weirgate.operators.normalise import numbered_lines
from weirgate.plans.ingest import Ingested, admit, check
from weirgate.session import cut_lineage, tune_streaming
from weirgate.settings import DEFAULTS, Settings
from weirgate.sinks.commits import CommitLog, Run, filesystem
from weirgate.sinks.tables import DEAD_LETTERS, EVENTS, event_rows, insert_events, quarantined, upsert_hourly
from weirgate.sinks.topics import RECORD
from weirgate.sources.json_events import stream_events

ADMISSIONS = "event_id string, admitted_at timestamp, admitted_on date, bucket int"
OUTCOMES = "event_id string, event_type string, user_id string, received_at timestamp, admitted boolean, outcome string, topic string"
REJECTS = "error string, details array<string>, correlation_id string"
BUCKETS = 16


@dataclass(frozen=True)
class IngestStream:
    """Tables below one root; ``writer`` names the stream in the log."""

    root: str
    settings: Settings = DEFAULTS
    writer: str = "stream"

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.root)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """Committed rows of one of the tables that every writer has."""
        schemas = {
            "outcomes": OUTCOMES, "rejects": REJECTS, "topics": RECORD, "events": EVENTS,
            "dead_letters": DEAD_LETTERS, "admissions": ADMISSIONS,
        }
        return self.log(spark).read(table, schemas[table])


def bucket(event_id: Column) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(BUCKETS)).cast("int")


def stored_admissions(run: Run, rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Admissions that can matter to the rows: from the first day within reach on, in the buckets of their ids.

    Later days count too: a late row is a repeat of one that came before it.
    """
    reach = F.to_date(shift(F.min("received_at"), -3600 * settings.ttl_hours))
    since, buckets = rows.agg(reach, F.collect_set(bucket(F.col("event_id")))).first()
    seen = run.read("admissions", ADMISSIONS, since)
    return seen.filter(F.col("bucket").isin(buckets)).select("event_id", "admitted_at")


def write_admissions(run: Run, outcomes: DataFrame) -> None:
    admitted = outcomes.filter("admitted").select(
        "event_id", F.col("received_at").alias("admitted_at"), F.to_date("received_at").alias("admitted_on"),
        bucket(F.col("event_id")).alias("bucket"),
    )
    run.write("admissions", admitted.repartition("bucket"), by=("admitted_on", "bucket"))


def write_flow(run: Run, flow: Ingested) -> Ingested:
    """The outputs that every way in has; returns the flow over the stored outcomes."""
    path = run.write("outcomes", flow.outcomes)
    done = replace(flow, outcomes=flow.outcomes.sparkSession.read.schema(flow.outcomes.schema).parquet(path))
    run.write("rejects", done.rejects)
    run.write("dead_letters", done.dead_letters)
    events = event_rows(done.outcomes)
    insert_events(run, events)
    run.write("quarantine", quarantined(events))
    run.write("topics", done.published.unionByName(done.dead_letter_records), by=("topic",))
    upsert_hourly(run, done.outcomes)
    write_admissions(run, done.outcomes)
    return done


def tidy(log: CommitLog) -> None:
    """Merges the parts of the tables that grow by one a micro-batch."""
    log.compact("admissions", ADMISSIONS, sort="event_id", by=("admitted_on", "bucket"))
    log.compact("events", f"{EVENTS}, created_on date", sort="event_id", by=("created_on",))


def ingest_batch(decoded: DataFrame, batch: int, sink: IngestStream) -> bool:
    """All outputs of one micro-batch; False if it was committed before."""
    spark = decoded.sparkSession
    log = sink.log(spark)
    if log.run(sink.writer, batch).is_done:
        return False
    # Arrival numbers are fixed here, once; everything later reads the checked rows back.
    rows = cut_lineage(check(numbered_lines(decoded), "stream", settings=sink.settings))
    if rows.isEmpty():
        return False
    malformed, good = cut_lineage(malformed_requests(rows)), well_formed(rows)

    def work(run: Run) -> None:
        run.write("malformed", malformed)
        write_flow(run, admit(good, stored_admissions(run, rows, sink.settings), sink.settings))

    committed = log.retried(work, sink.writer, batch)
    tidy(log)
    return committed


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint; a new checkpoint counts its batches anew."""
    fs, path = filesystem(spark, f"{checkpoint}/metadata")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def start_ingest(
    spark: SparkSession,
    source: str,
    sink: IngestStream,
    checkpoint: str,
    max_files: int = 64,
    every: str | None = None,
    recorded: bool = False,
) -> StreamingQuery:
    """Start the stream: until the backlog is empty, or forever ``every`` so often."""
    tune_streaming(spark)
    events = stream_events(spark, source, max_files, recorded)

    def each(df: DataFrame, number: int) -> None:
        ingest_batch(df, number, replace(sink, writer=f"stream-{stream_id(spark, checkpoint)}"))

    writer = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
