"""Streams: equal to the batch result, also over several micro-batches and after a restart."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from weirgate.catalog.q_sources import wire_json
from weirgate.catalog.registry import wire
from weirgate.operators.alerts import critical_bursts
from weirgate.operators.dedup import mark_admitted
from weirgate.operators.enrich import enrich, match_transactions
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.validation import valid_rows, validate
from weirgate.operators.windows import aggregate_events, sessions, tumbling
from weirgate.session import scratch_path, tune_streaming
from weirgate.sinks.commits import CommitLog
from weirgate.sinks.tables import HOURLY, current_hourly
from weirgate.sources.tables import table
from weirgate.streaming.ingest import IngestStream, start_ingest
from weirgate.streaming.patterns import stream_bursts, stream_matches
from weirgate.streaming.ttl_state import draining, stream_ttl_dedup
from weirgate.streaming.windows import closing_row, stream_aggregate, stream_windowed

SF = "/root/testdata/sf0.001"
CUTS = ("2024-01-01", "2024-01-10", "2024-01-20", "2024-03-01")


@pytest.fixture(scope="module")
def rows(spark):
    tune_streaming(spark)
    return wire(spark, SF).cache()


def parts(df):
    """The month in three pieces, in order of arrival."""
    at = F.col("received_at")
    return [df.filter((at >= F.lit(a).cast("timestamp")) & (at < F.lit(b).cast("timestamp"))) for a, b in zip(CUTS, CUTS[1:])]


def drain(stream, path, marks):
    run = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", marks)
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_ttl_state_over_restarts(spark, rows):
    slim = rows.select("event_id", "attempt", "received_at", "seq")
    source, out, marks = (scratch_path(spark, f"test-{x}") for x in "abc")
    for part in parts(slim):
        # One file per piece, so a piece is one micro-batch; each loop is a restart.
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(slim.schema).parquet(source)
        with draining(spark):
            drain(stream_ttl_dedup(stream).select("event_id", "attempt", "admitted"), out, marks)
    assert same(spark.read.parquet(out), mark_admitted(slim).select("event_id", "attempt", "admitted"))


def arrivals(spark):
    """Ids with one arrival, some and a hundred; equal instants, repeated rows, an id that is null, and other columns of many kinds."""
    n = F.col("id")
    hours = F.when(n % 3 == 0, F.pmod(F.xxhash64(n), F.lit(200))).otherwise(n % 70)
    return spark.range(1200).select(
        F.when(n % 12 == 0, "hot").when(n % 50 != 7, F.concat(F.lit("e"), n % 400)).alias("event_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_001) + hours * F.lit(3_600_000_000)).alias("received_at"),
        (n % 9).alias("seq"), F.when(n % 4 != 0, n).alias("no"), (n / 7).alias("share"),
        F.to_date(F.lit("2024-01-01")).alias("day"), F.create_map(F.lit("k"), n.cast("string")).alias("pairs"),
        F.struct(n.cast("decimal(12,2)").alias("cents"), F.array(n).alias("list")).alias("more"),
        F.lit("2024-05-01 10:00:00").cast("timestamp").alias("sent_at"),
    ).unionByName(
        spark.range(1).select(
            F.lit("twice").alias("event_id"), F.lit("2024-01-02").cast("timestamp").alias("received_at"), F.lit(0).cast("bigint").alias("seq"),
            *[F.lit(None).cast(t).alias(c) for c, t in KINDS],
        ).withColumn("x", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).drop("x")
    )


KINDS = [
    ("no", "bigint"), ("share", "double"), ("day", "date"), ("pairs", "map<string,string>"),
    ("more", "struct<cents:decimal(12,2),list:array<bigint>>"), ("sent_at", "timestamp"),
]


def judged(batches, ttl=timedelta(hours=24)):
    """(event_id, received_at, seq, admitted) by a plain loop over the micro-batches."""
    last, out = {}, Counter()
    for batch in batches:
        for r in sorted(batch, key=lambda r: (r["received_at"], r["seq"])):
            won = r["event_id"] not in last or r["received_at"] >= last[r["event_id"]] + ttl
            if won:
                last[r["event_id"]] = r["received_at"]
            out[r["event_id"], r["received_at"], r["seq"], won] += 1
    return out


@pytest.mark.parametrize("small", [False, True])
def test_ttl_state_by_buckets(spark, monkeypatch, small):
    """Few states for many ids, whatever the size of packs and chunks; nothing else about the rows changes."""
    from weirgate.streaming import ttl_state

    if small:
        for name, value in {"GATHERED_ROWS": 100, "PACK_ROWS": 3, "CHUNKS": 2}.items():
            monkeypatch.setattr(ttl_state, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64" if small else "10000")
    source, out, marks = (scratch_path(spark, f"test-b{x}") for x in "iom")
    every = arrivals(spark).withColumn("batch", F.pmod(F.xxhash64("received_at"), F.lit(5)))
    batches = []
    try:
        for b in range(5):
            part = every.filter(F.col("batch") == b).drop("batch")
            batches.append(part.select("event_id", "received_at", "seq").collect())
            part.repartition(2).write.mode("append").parquet(source)
            with draining(spark):
                drain(stream_ttl_dedup(spark.readStream.schema(part.schema).parquet(source), buckets=7), out, marks)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = spark.read.parquet(out)
    assert got.columns == [*every.drop("batch").columns, "admitted"]
    assert Counter(map(tuple, got.select("event_id", "received_at", "seq", "admitted").collect())) == judged(batches)
    assert same(got.drop("admitted"), every.drop("batch"))
    chunks = spark.read.format("statestore").option("path", marks).option("stateVarName", "admitted").load()
    assert chunks.select("key").distinct().count() == 7
    assert chunks.count() <= 7 * (2 if small else 5)


def test_ttl_state_of_an_id_is_not_kept_by_its_bucket():
    """Merging the chunks of a bucket does not put off when the states of its ids go away."""
    from pyspark.sql import Row
    from weirgate.streaming.ttl_state import CHUNKS, TtlDedup

    class State(list):
        get = list.__iter__
        appendValue = list.append

        def put(self, chunks):
            self[:] = chunks

    class Clock:
        def __init__(self, now):
            self.getCurrentProcessingTimeInMs = lambda: now

    dedup = TtlDedup(["event_id", "_at", "seq"], 100, 1000)
    dedup.admitted = State()

    def admitted(now, one, at):
        pack = Row(event_id=[one], _at=[at], seq=[0])
        return [r["admitted"] for r in dedup.handleInputRows((0,), iter([pack]), Clock(now))] == [[True]]

    assert admitted(0, "old", 500)
    assert [admitted(1 + i, f"e{i}", 500) for i in range(2 * CHUNKS)] == [True] * (2 * CHUNKS)
    assert len(dedup.admitted) <= CHUNKS
    assert not admitted(999, "old", 550)
    assert admitted(1000, "old", 550) and not admitted(1000, "e5", 550)
    # As before, a row without an instant ends the stream; it is not taken for a repeat.
    with pytest.raises(ValueError, match="without an instant"):
        admitted(1000, "none", None)


def test_late_half_is_written_by_all_tasks(spark, tmp_path, monkeypatch):
    """Neither half of the month goes through one task, and every row of both comes out."""
    from weirgate.catalog import q_streaming as q

    n = F.col("id")
    events = spark.range(0, 4000, 1, 4).select(
        n.alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + n * 640).cast("timestamp_ntz").alias("ts"),
        (n % 50).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.0).alias("value"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    paths = {}
    monkeypatch.setattr(q, "scratch_path", lambda spark, label: paths.setdefault(label, scratch_path(spark, label)))
    got = q.t2_late(spark, str(tmp_path))
    want = wire(spark, str(tmp_path))
    assert same(got, want.join(want.groupBy("event_id").agg(F.count(F.lit(1)).alias("arrivals")), "event_id").select(*got.columns))
    files = spark.read.parquet(paths["t2-in"]).select(F.col("_metadata.file_name").alias("file"), (F.col("received_at") < "2024-01-16").alias("late"))
    written = files.groupBy("late").agg(F.countDistinct("file").alias("files")).collect()
    assert len(written) == 2 and all(r["files"] > 1 for r in written)


def test_ingest_over_restarts(spark, rows):
    source, marks = scratch_path(spark, "test-in"), scratch_path(spark, "test-marks")
    sink = IngestStream(scratch_path(spark, "test-out"))
    for part in parts(rows):
        wire_json(part).coalesce(1).write.mode("append").text(source)
        start_ingest(spark, source, sink, marks, recorded=True).awaitTermination()
    done = sink.read(spark, "outcomes")
    good = valid_rows(validate(fill_defaults(rows)))
    want = mark_admitted(good.drop("errors"))
    assert same(done.select("event_id", "received_at", "admitted"), want.select("event_id", "received_at", "admitted"))
    assert done.select("run").distinct().count() == 3
    rejected = sink.read(spark, "rejects").count()
    assert rejected + done.count() == rows.count()
    hourly = current_hourly(sink.log(spark))
    assert hourly.columns == [c.split()[0] for c in HOURLY.split(", ")]
    assert hourly.agg(F.sum("total_count")).first()[0] == done.count()
    topics = sink.read(spark, "topics")
    assert topics.count() == done.filter("outcome = 'processed'").count()


def test_replayed_batch_changes_nothing(spark, rows):
    from weirgate.streaming.ingest import ingest_batch

    sink = IngestStream(scratch_path(spark, "test-replay"))
    decoded = rows.withColumns({"malformed": F.lit(None).cast("string"), "batch_id": F.lit("f")}).drop("seq")
    assert [ingest_batch(decoded, 0, sink) for _ in range(2)] == [True, False]
    done = sink.read(spark, "outcomes").count()
    assert done + sink.read(spark, "rejects").count() == rows.count()
    assert current_hourly(sink.log(spark)).agg(F.sum("total_count")).first()[0] == done


def test_crash_between_outputs_shows_nothing(spark, rows, monkeypatch):
    from weirgate.streaming import ingest

    sink = IngestStream(scratch_path(spark, "test-crash"))
    decoded = rows.withColumns({"malformed": F.lit(None).cast("string"), "batch_id": F.lit("f")}).drop("seq")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "upsert_hourly", lost)
        with pytest.raises(RuntimeError):
            ingest.ingest_batch(decoded, 0, sink)
    assert sink.log(spark).state().version == -1
    assert sink.read(spark, "outcomes").count() == sink.read(spark, "events").count() == 0
    assert ingest.ingest_batch(decoded, 0, sink)
    done = sink.read(spark, "outcomes").count()
    assert done > 0 and sink.log(spark).sweep(0) > 0 and sink.read(spark, "outcomes").count() == done


@pytest.fixture(scope="module")
def stream_of(spark, rows):
    """The wire events as a stream of one micro-batch, closed by one late row per window."""
    source = scratch_path(spark, "test-stream")
    last = rows.limit(1).withColumn("received_at", F.lit("2024-06-01").cast("timestamp")).withColumn("user_id", F.lit("closing"))
    rows.coalesce(1).write.parquet(source)
    last.coalesce(1).write.mode("append").parquet(source)
    # Two more micro-batches, because a window is emitted by the batch after the watermark passed it.
    last.withColumn("received_at", F.lit("2024-06-02").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
    return lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)


@pytest.mark.parametrize("kind", ["tumbling", "session"])
def test_stream_windows(spark, rows, stream_of, kind):
    out, marks = scratch_path(spark, "test-w"), scratch_path(spark, "test-wm")
    # The delay covers the whole month: files of one folder may come in any order.
    drain(stream_windowed(stream_of(), kind, ["user_id"], "1 hour", delay="40 days"), out, marks)
    got = spark.read.parquet(out).filter("user_id <> 'closing'").select("user_id", "window_start", "window_end", "events")
    if kind == "tumbling":
        want = tumbling(rows, ["user_id"], 3600).select("user_id", "window_start", "window_end", "events")
    else:
        want = sessions(rows, "user_id", 3600).select("user_id", "session_start", "session_end", "events")
    assert same(got, want)


def test_stream_aggregate(spark, rows, stream_of):
    out, marks = scratch_path(spark, "test-a"), scratch_path(spark, "test-am")
    drain(stream_aggregate(stream_of(), delay="40 days"), out, marks)
    got = spark.read.parquet(out).filter("window_start < timestamp'2024-05-01'").select("window_start", "event_type", "events")
    assert same(got, aggregate_events(rows).select("window_start", "event_type", "events"))


def state_rows(spark, marks, name):
    return spark.read.format("statestore").option("path", marks).option("stateVarName", name).load().count()


def patterns_of(spark, rows, build, batches=4):
    """Shuffled micro-batches, then two rows that close everything; what came out, and where the state is."""
    source, out, marks = (scratch_path(spark, f"test-p{x}") for x in "iom")
    result = None
    # A closing row moves the watermark past the rows; the second one past what was remembered of them.
    closing = closing_row(rows, "40 days", "40 days")
    for part in (rows.repartition(batches), closing, closing_row(closing, "40 days", "40 days")):
        part.write.mode("append").parquet(source)
        result = build(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source))
        drain(result, out, marks)
    return spark.read.schema(result.schema).parquet(out), marks


def test_stream_patterns(spark, rows):
    got, marks = patterns_of(spark, rows, lambda s: stream_bursts(s, n=2, within=4 * 3600, delay="40 days"))
    assert same(got, critical_bursts(rows, n=2, within=4 * 3600).select("user_id", "alert_at"))
    assert state_rows(spark, marks, "waiting") == state_rows(spark, marks, "last") == 0
    got, marks = patterns_of(spark, rows, lambda s: stream_matches(s, bound=86400, delay="40 days"))
    columns = ("user_id", "closed_id", "opened_id", "closed_at", "opened_at")
    assert same(got.select(*columns), match_transactions(rows, bound=86400).select(*columns))
    assert state_rows(spark, marks, "waiting") == state_rows(spark, marks, "last") == 0


def test_stream_patterns_of_a_hot_user(spark):
    """A third of the rows is one user's, many at one instant or in one millisecond."""
    n = F.col("id")
    kind = F.when(n % 5 == 0, "transaction.created").when(n % 5 == 1, "transaction.completed").otherwise("fraud.detected")
    hot = spark.range(3000).select(
        F.concat(F.lit("e"), n).alias("event_id"), kind.alias("event_type"),
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), n % 40)).alias("user_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.pmod(F.xxhash64(n), F.lit(700)) * F.lit(7_000_400) + n % 2 * 100).alias("received_at"),
    )
    got, _ = patterns_of(spark, hot, lambda s: stream_bursts(s, n=3, within=60, delay="40 days"), 3)
    want = critical_bursts(hot, n=3, within=60).select("user_id", "alert_at")
    assert want.count() > 300 and same(got, want)
    got, _ = patterns_of(spark, hot, lambda s: stream_matches(s, bound=120, delay="40 days"), 3)
    columns = ("user_id", "closed_id", "opened_id", "closed_at", "opened_at")
    want = match_transactions(hot, bound=120).select(*columns)
    assert want.count() >= 200 and same(got.select(*columns), want)


def test_stream_static_enrichment(spark):
    people = table(spark, SF, "customer").select("c_custkey", "c_name")
    source = scratch_path(spark, "test-e")
    facts = table(spark, SF, "events").select("event_id", "user_id")
    facts.write.parquet(source)
    out = scratch_path(spark, "test-eo")
    on = F.col("user_id") == F.col("c_custkey")
    drain(enrich(spark.readStream.schema(facts.schema).parquet(source), people, on), out, scratch_path(spark, "test-em"))
    assert same(spark.read.parquet(out).select("event_id", "c_name"), enrich(facts, people, on).select("event_id", "c_name"))


@pytest.mark.parametrize("kind", ["tumbling", "sessions"])
def test_stream_windows_hold_every_event(spark, kind):
    from weirgate.catalog import q_streaming as q

    n = table(spark, SF, "events").count()
    for x in ("", "_all"):
        assert getattr(q, f"r1_stream_{kind}{x}")(spark, SF).agg(F.sum("events")).first()[0] == n


def test_windows_and_late_rows_are_all_rows(spark, rows):
    """Six micro-batches out of order: what is behind the watermark is late, by a plain loop over the batches."""
    from weirgate.streaming.windows import stored_windows, window_batch

    log = CommitLog(spark, scratch_path(spark, "test-late"))
    slim = rows.select("event_type", "received_at").withColumn("batch", F.pmod(F.xxhash64("received_at"), F.lit(6)))
    for n in range(6):
        batch = slim.filter(F.col("batch") == n).drop("batch")
        assert window_batch(batch, n, log, ["event_type"], 3600, 5 * 86400, "s")
        assert not window_batch(batch, n, log, ["event_type"], 3600, 5 * 86400, "s")
    late, mark = 0, None
    kept: Counter = Counter()
    for n in range(6):
        batch = slim.filter(F.col("batch") == n).collect()
        for r in batch:
            if mark is not None and r["received_at"] < mark - timedelta(days=5):
                late += 1
            else:
                kept[r["event_type"], r["received_at"].replace(minute=0, second=0, microsecond=0)] += 1
        mark = max([r["received_at"] for r in batch] + ([mark] if mark else []))
    got = stored_windows(spark, log.root, "event_type string", 3600)
    assert {(r["event_type"], r["window_start"]): r["events"] for r in got.collect()} == kept
    assert log.read("late", "event_type string, received_at timestamp").count() == late > 0
    assert kept.total() + late == rows.count()
