"""The command line jobs, chained."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from weirgate.__main__ import main
from weirgate.operators.normalise import fill_defaults
from weirgate.plans.reprocess import reprocess
from weirgate.session import scratch_path, setting
from weirgate.sinks.commits import CommitLog
from weirgate.settings import DEFAULTS
from weirgate.sinks.tables import DEAD_LETTERS, current_hourly, stored_rollups
from weirgate.sources.json_events import read_batch_files, read_events
from weirgate.streaming.ingest import IngestStream, ingest_batch


def event(i: int, **more) -> str:
    return json.dumps({"eventId": f"g{i}", "eventType": "user.login", "userId": "u", "data": {}, **more})


def committed(spark, root: str, table: str):
    """What readers see of a table, with all its columns; None if it has no part."""
    paths = CommitLog(spark, root).paths(table)
    return spark.read.option("basePath", f"{root}/{table}").parquet(*paths) if paths else None


def test_ingest_stats(spark, capsys):
    made, out = scratch_path(spark, "job-made"), scratch_path(spark, "job-out")
    spark.createDataFrame([(event(i),) for i in range(300)], "value string").write.text(made)
    main(["ingest", "--source", made, "--out", out, "--checkpoint", scratch_path(spark, "job-marks")])
    main(["stats", "--out", out])
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["total_received"] == 300 and stats["success_rate"] == 100.0
    assert sum(stats["events_by_type"].values()) == 300


def test_batch_and_reprocess(spark):
    source, out, again = (scratch_path(spark, f"job-{x}") for x in ("requests", "tables", "again"))
    stamp = "2024-01-01T00:00:00.000Z"
    good = [{"eventId": f"e{i % 8}", "eventType": "user.login", "userId": "u", "timestamp": stamp} for i in range(10)]
    bodies = [good, [{**good[0], "eventId": "dots", "eventType": "..."}], [{**good[0], "userId": " "}], [{**good[0], "timestamp": "soon"}]]
    requests = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "i int, value string")
    requests.write.partitionBy("i").text(source)
    main(["batch", "--source", f"{source}/*", "--out", out])
    tables = ("outcomes", "events", "rejects", "dead_letters", "malformed", "acks", "quarantine")
    counts = {n: committed(spark, out, n).count() for n in tables}
    assert counts == {"outcomes": 11, "events": 8, "rejects": 1, "dead_letters": 1, "malformed": 1, "acks": 10, "quarantine": 0}
    topics = committed(spark, out, "topics").groupBy("topic").count().collect()
    assert {tuple(r) for r in topics} == {("events.user", 8), ("events.dlq", 1)}
    letters = scratch_path(spark, "job-letters")
    committed(spark, out, "dead_letters").write.parquet(letters)
    main(["reprocess", "--source", letters, "--out", again])
    row = committed(spark, again, "tried").select("status", "retry_count", F.col("last_retried_at").isNotNull().alias("t")).first()
    assert tuple(row) == ("failed", 1, True)
    # The counts are written back, so further rounds end.
    for _ in range(3):
        main(["reprocess", "--source", letters, "--out", again])
    rounds = committed(spark, again, "tried").orderBy("round").select("status", "retry_count").collect()
    assert [tuple(r) for r in rounds] == [("failed", 1), ("failed", 2), ("failed", 3), ("exhausted", 3)]


def test_second_batch_run_admits_nothing_again(spark):
    source, out = (scratch_path(spark, f"job2-{x}") for x in ("requests", "tables"))
    wide = "w" * 130
    bodies = [f"[{event(1)},{event(2, userId=wide)}]", f"[{event(1)}]"]
    spark.createDataFrame(list(enumerate(bodies)), "i int, value string").write.partitionBy("i").text(source)
    for _ in range(2):
        main(["batch", "--source", f"{source}/*", "--out", out, "--validate", "none"])
    first, second = (spark.read.parquet(p) for p in CommitLog(spark, out).paths("outcomes"))
    assert {tuple(r) for r in first.groupBy("event_id", "outcome").count().collect()} == {("g1", "processed", 1), ("g1", "duplicate", 1), ("g2", "processed", 1)}
    assert {tuple(r) for r in second.groupBy("event_id", "outcome").count().collect()} == {("g1", "duplicate", 2), ("g2", "duplicate", 1)}
    assert [r["event_id"] for r in committed(spark, out, "events").collect()] == ["g1"]
    # Too wide for the events table: kept whole in quarantine.
    held = committed(spark, out, "quarantine").collect()
    assert [(r["event_id"], r["too_long"], wide in r["row"]) for r in held] == [("g2", ["user_id"], True)]


def test_clock_of_the_body_counts_only_when_asked(spark):
    path = scratch_path(spark, "clock")
    lines = [event(1, receivedAt="2001-01-01T00:00:00.000Z"), '{"eventId":"d","eventType":"user.login","userId":"u","data":{"a":1,"a":2}}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    years = {n: {r["event_id"]: r["received_at"].year for r in read_events(spark, path, recorded=n).collect()} for n in (False, True)}
    assert years[True]["g1"] == 2001 and years[False]["g1"] > 2001
    rows = {r["event_id"]: r for r in read_events(spark, path).collect()}
    assert rows["d"]["malformed"] is None and rows["d"]["data"] == '{"a":2}'


def test_late_row_is_a_repeat_alone_and_in_company(spark):
    def batch(*rows):
        df = spark.createDataFrame(rows, "event_id string, received_at timestamp")
        more = {"event_type": F.lit("user.login"), "user_id": F.lit("u"), "event_ts": F.col("received_at"), "malformed": F.lit(None).cast("string"), "batch_id": F.lit("b"), "entry": F.lit("stream")}
        return df.withColumns(more)

    day = lambda d, h=0: datetime(2024, 1, d, h)
    for company in ((), (("y", day(9)),)):
        sink = IngestStream(scratch_path(spark, "late"))
        ingest_batch(batch(("x", day(9))), 0, sink)
        ingest_batch(batch(("x", day(5)), *company), 1, sink)
        rows = sink.read(spark, "outcomes").filter("event_id = 'x'").orderBy("received_at").collect()
        assert [r["outcome"] for r in rows] == ["duplicate", "processed"]


def test_all_jobs_share_a_folder(spark, capsys):
    """Batch, stream, batch and a round over the dead letters: nothing is lost or counted twice."""
    out, marks, lines = (scratch_path(spark, f"all-{x}") for x in ("out", "marks", "lines"))
    stamp = "2024-01-01T00:00:00.000Z"

    def batch(name: str, *ids: str) -> None:
        folder = scratch_path(spark, f"all-{name}")
        body = json.dumps([{"eventId": i, "eventType": "..." if i == "dots" else "user.login", "userId": "u", "timestamp": stamp} for i in ids])
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(folder)
        main(["batch", "--source", folder, "--out", out])

    def stream(*ids: int) -> None:
        spark.createDataFrame([(event(i),) for i in ids], "value string").write.mode("append").text(lines)
        main(["ingest", "--source", lines, "--out", out, "--checkpoint", marks])

    batch("a", "g1", "g2", "dots")
    stream(2, 3)
    batch("b", "g3", "g4", "g1")
    stream(4, 5)
    main(["reprocess", "--out", out])
    main(["stats", "--out", out])
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (stats["total_received"], stats["total_processed"], stats["total_failed"], stats["total_duplicated"]) == (10, 5, 1, 4)
    hourly = current_hourly(CommitLog(spark, out)).agg(F.sum("total_count"), F.sum("success_count"), F.sum("failure_count")).first()
    assert tuple(hourly) == (10, 5, 1)
    assert sorted(r["event_id"] for r in committed(spark, out, "events").collect()) == ["g1", "g2", "g3", "g4", "g5"]
    assert [(r["event_id"], r["retry_count"]) for r in committed(spark, out, "letters").collect()] == [("dots", 1)]
    assert committed(spark, out, "dead_letters") is None
    main(["sweep", "--out", out, "--hours", "0"])
    assert IngestStream(out).read(spark, "outcomes").count() == 10


def test_aggregates_are_published_once_per_change(spark):
    """Two runs of the stream, the rollups after each: hours that changed come again, merged."""
    out, marks, lines = (scratch_path(spark, f"agg-{x}") for x in ("out", "marks", "lines"))
    values = []
    for ids in (range(40), range(20, 60)):
        text = [(event(i, userId=f"u{i % 30}", data={"amount": i}),) for i in ids]
        spark.createDataFrame(text, "value string").write.mode("append").text(lines)
        main(["ingest", "--source", lines, "--out", out, "--checkpoint", marks])
        for _ in range(2):
            # The second call finds nothing new.
            main(["aggregate", "--out", out])
        records = committed(spark, out, "topics").filter("topic = 'analytics.aggregated'")
        values.append([json.loads(r["value"]) for r in records.collect()])
    assert sum(v["events"] for v in values[0]) == 40 and len({v["window_start"] for v in values[1]}) <= 2
    whole = stored_rollups(CommitLog(spark, out), "week").agg(F.sum("events"), F.sum("amount_sum"), F.hll_sketch_estimate(F.hll_union_agg("users"))).first()
    assert tuple(whole) == (60, sum(range(60)), 30)


def test_oversized_request_is_a_row_and_the_job_goes_on(spark):
    source, out = scratch_path(spark, "size-in"), scratch_path(spark, "size-out")
    bodies = [f"[{event(1)}]", "[" + " " * 5000 + f"{event(2)}]", "{"]
    spark.createDataFrame(list(enumerate(bodies)), "i int, value string").write.partitionBy("i").text(source)
    small = replace(DEFAULTS, max_request_bytes=4000)
    rows = read_batch_files(spark, f"{source}/*", settings=small)
    assert {(r["event_id"], r["malformed"]) for r in rows.collect()} == {("g1", None), (None, "size"), (None, "json")}
    # The length is tested where files are listed, so the body of a long file is not opened.
    assert "LessThanOrEqual(length,4000)" in rows._jdf.queryExecution().toString()
    main(["batch", "--source", f"{source}/*", "--out", out, "--max-request-bytes", "4000"])
    assert sorted(r["cause"] for r in committed(spark, out, "malformed").collect()) == ["json", "size"]
    assert [r["event_id"] for r in committed(spark, out, "events").collect()] == ["g1"]


def test_round_over_letters_applies_the_rules(spark):
    letter = {"error_reason": "r", "retry_count": 0, "created_at": datetime(2024, 1, 2), "last_retried_at": None}
    stamp = "2024-01-02T00:00:00.000Z"
    bodies = {
        "good": {"userId": "u", "timestamp": stamp}, "user": {"userId": "bad user!", "timestamp": stamp},
        "blank": {"userId": " ", "timestamp": stamp}, "cut": None,
    }
    rows = [
        (k, "user.login", "u", "{" if b is None else json.dumps({"eventId": k, "eventType": "user.login", "data": {}, **b}), *letter.values())
        for k, b in bodies.items()
    ]
    letters = spark.createDataFrame(rows, DEAD_LETTERS)
    for mode, fine in {"none": {"good", "user", "blank"}, "annotations": {"good", "user"}, "full": {"good"}}.items():
        tried = {r["event_id"]: r for r in reprocess(letters, F.current_timestamp(), mode=mode).collect()}
        assert {k for k, r in tried.items() if r["status"] == "recovered"} == fine
        assert all(r["retry_count"] == 1 for r in tried.values()) and tried["cut"]["error_reason"] == "r"
    assert "userId contains invalid" in tried["user"]["error_reason"]


def test_made_up_ids_do_not_follow_the_splits(spark):
    path = scratch_path(spark, "splits")
    same = json.dumps({"eventType": "user.login", "userId": "hot", "timestamp": "2024-01-01T00:00:00.000Z"})
    lines = [json.dumps({"eventType": "user.login", "userId": f"u{i}"}) if i % 3 else same for i in range(5000)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)

    def ids(size: str) -> list[str]:
        with setting(spark, "spark.sql.files.maxPartitionBytes", size):
            rows = fill_defaults(read_events(spark, path))
            assert rows.rdd.getNumPartitions() > 0
            return sorted(r["event_id"] for r in rows.select("event_id").collect())

    a, b = ids("128m"), ids("20k")
    assert a == b and len(set(a)) == 5000
