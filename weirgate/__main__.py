"""Jobs for spark-submit: ``python -m weirgate <job> ...``.

    ingest     folder of newline-delimited events -> all outputs, once or continuously
    batch      folder of JSON arrays, one request per file -> tables
    stats      statistics over what was ingested, as JSON
    reprocess  dead letters -> another try
    aggregate  what came since the last time -> hourly rollups and their topic
    sweep      files of lost runs -> gone

All jobs may share one folder; see `weirgate.sinks.commits`.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weirgate.operators.batches import guard_batches, malformed_requests, well_formed
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.outcome import PROCESSED, batch_responses
from weirgate.operators.totals import stats_snapshot
from weirgate.plans.ingest import ingest
from weirgate.plans.reprocess import recovered_outcomes, reprocess, still_waiting
from weirgate.session import cut_lineage, tune
from weirgate.settings import DEFAULTS
from weirgate.sinks import tables, topics
from weirgate.sinks.commits import CommitLog, Run
from weirgate.sources.json_events import read_batch_files
from weirgate.streaming.ingest import IngestStream, start_ingest, stored_admissions, tidy, write_flow


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    start_ingest(spark, args.source, IngestStream(args.out), args.checkpoint, args.max_files, args.every).awaitTermination()


def run_batch(spark: SparkSession, args: argparse.Namespace) -> None:
    """Malformed and oversized requests, rejects, events, dead letters, topics and metrics, in one commit."""
    decoded = cut_lineage(read_batch_files(spark, args.source, settings=replace(DEFAULTS, max_request_bytes=args.max_request_bytes)))
    rows = well_formed(decoded)
    named = fill_defaults(rows).select("event_id", "received_at")

    def work(run: Run) -> None:
        run.write("malformed", malformed_requests(decoded))
        run.write("oversized", guard_batches(rows).rejected)
        done = write_flow(run, ingest(rows, "batch", args.validate, stored_admissions(run, named)))
        run.write("acks", done.acks)
        run.write("responses", batch_responses(done.outcomes))

    log = CommitLog(spark, args.out)
    log.retried(work)
    tidy(log)


def run_stats(spark: SparkSession, args: argparse.Namespace) -> None:
    print(stats_snapshot(IngestStream(args.out).read(spark, "outcomes")).toJSON().first())


def run_reprocess(spark: SparkSession, args: argparse.Namespace) -> None:
    """One more try for every letter: what waits, and what came in since.

    New letters come from the folder's own dead letters or, in the first round, from ``source``. What
    recovers is stored, published and counted like any other event, in the commit that takes it off
    the waiting letters.
    """
    log = CommitLog(spark, args.out)
    number = log.state().done.get("reprocess", -1) + 1
    names = [c.split()[0] for c in tables.DEAD_LETTERS.split(", ")]

    def work(run: Run) -> None:
        letters = run.read("letters", tables.DEAD_LETTERS).select(*names)
        if args.source is None:
            letters = letters.unionByName(run.read("dead_letters", tables.DEAD_LETTERS).select(*names))
            run.remove("dead_letters", run.base.parts.get("dead_letters", ()))
        elif number == 0:
            letters = letters.unionByName(spark.read.parquet(args.source).select(*names))
        tried = cut_lineage(reprocess(letters, F.current_timestamp(), mode=args.validate))
        run.write("tried", tried.withColumn("round", F.lit(number)))
        events = cut_lineage(recovered_outcomes(tried))
        run.write("outcomes", events)
        run.write("topics", topics.published_records(events), by=("topic",))
        tables.insert_events(run, tables.event_rows(events))
        tables.upsert_hourly(run, events)
        run.remove("letters", run.base.parts.get("letters", ()))
        run.write("letters", still_waiting(tried))

    log.retried(work, "reprocess", number)


def run_aggregate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Adds the processed events of new parts to the rollups and publishes the hours that changed, in one commit.

    Parts of outcomes are only ever added, so their number says what was taken before.
    """
    log = CommitLog(spark, args.out)
    state = log.state()
    first, last = state.done.get("aggregate", -1) + 1, len(state.parts.get("outcomes", ())) - 1
    columns = "event_type string, user_id string, data string, received_at timestamp, outcome string"

    def work(run: Run) -> None:
        new = log.rows("outcomes", run.base.parts["outcomes"][first : last + 1], columns).filter(F.col("outcome") == PROCESSED)
        run.write("topics", topics.aggregated_records(tables.add_rollup(run, new)), by=("topic",))

    if last >= first:
        log.retried(work, "aggregate", last)


def run_sweep(spark: SparkSession, args: argparse.Namespace) -> None:
    """Removes what lost or overtaken runs left, once it is ``--hours`` old."""
    print(CommitLog(spark, args.out).sweep(int(args.hours * 3_600_000)))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="weirgate", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("ingest")
    job.add_argument("--source", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--max-files", type=int, default=64)
    job.add_argument("--every", help="trigger interval; without it the backlog is drained once")
    job.set_defaults(run=run_ingest)
    job = jobs.add_parser("batch")
    job.add_argument("--source", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--validate", choices=("annotations", "full", "none"), default="annotations")
    job.add_argument("--max-request-bytes", type=int, default=DEFAULTS.max_request_bytes, help="longer files are refused unread")
    job.set_defaults(run=run_batch)
    job = jobs.add_parser("stats")
    job.add_argument("--out", required=True)
    job.set_defaults(run=run_stats)
    job = jobs.add_parser("reprocess")
    job.add_argument("--source", help="folder of dead letters; without it those below --out")
    job.add_argument("--out", required=True)
    job.add_argument("--validate", choices=("annotations", "full", "none"), default="annotations")
    job.set_defaults(run=run_reprocess)
    job = jobs.add_parser("aggregate")
    job.add_argument("--out", required=True)
    job.set_defaults(run=run_aggregate)
    job = jobs.add_parser("sweep")
    job.add_argument("--out", required=True)
    job.add_argument("--hours", type=float, default=48)
    job.set_defaults(run=run_sweep)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(tune(SparkSession.builder.appName(f"weirgate-{args.job}").getOrCreate()), args)


if __name__ == "__main__":
    main()
