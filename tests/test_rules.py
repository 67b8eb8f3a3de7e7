"""Rules, defaults and outcomes at their boundaries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.functions import envelope, rules, text
from weirgate.operators import outcome, totals
from weirgate.operators.batches import guard_batches
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.validation import validate
from weirgate.plans.ingest import ingest
from weirgate.sinks.tables import over_limits
from weirgate.sources.json_events import decode_batches, decode_lines

EVENT = "event_id string, event_type string, user_id string, event_ts string, data string, received_at string, seq bigint"


def events(spark, *rows):
    """Rows given as dicts over a valid event."""
    base = {
        "event_id": "e1", "event_type": "user.login", "user_id": "u1", "event_ts": "2024-01-02 00:00:00",
        "data": "{}", "received_at": "2024-01-02 00:00:00", "seq": 0,
    }
    full = [tuple({**base, **r}.values()) for r in rows]
    df = spark.createDataFrame(full, EVENT)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("event_ts", "received_at")})


def errors(spark, **fields):
    return validate(fill_defaults(events(spark, fields))).first()["errors"]


@pytest.mark.parametrize("bad", ["user", "User.login", "user_x.login", "user.login\n", "user..x", ".", "user.9x"])
def test_type_format(spark, bad):
    assert errors(spark, event_type=bad) == [fv.EVENT_TYPE_FORMAT]


@pytest.mark.parametrize("good", ["a1.b_2.c", "user.never_seen", "error.app"])
def test_type_accepted(spark, good):
    assert errors(spark, event_type=good) == []


@pytest.mark.parametrize("blank", [None, "", " \t", " "])
def test_blank_type_and_user(spark, blank):
    assert errors(spark, event_type=blank, user_id=blank) == [fv.EVENT_TYPE_REQUIRED, fv.USER_ID_REQUIRED]


def test_user_id_length(spark):
    assert errors(spark, user_id="a" * 128) == []
    assert errors(spark, user_id="a" * 129) == [fv.USER_ID_FORMAT]
    assert errors(spark, user_id="u1\n") == [fv.USER_ID_FORMAT]


@pytest.mark.parametrize(
    "sent, hours",
    [
        ("2024-01-01 00:00:00", None), ("2023-12-31 23:00:01", None), ("2023-12-31 23:00:00", 25),
        ("2024-01-03 00:59:59", None), ("2024-01-03 01:00:00", 25), ("2023-12-01 00:00:00", 768),
    ],
)
def test_drift(spark, sent, hours):
    want = [] if hours is None else [f"timestamp drift is {hours} hours — maximum allowed is 24 hours"]
    assert errors(spark, event_ts=sent) == want


@pytest.mark.parametrize("data, ok", [("{}", True), ("null", True), (None, True), ("[1]", False), ("3", False), ('"{\\"a\\":1}"', False)])
def test_payload_kind(spark, data, ok):
    assert errors(spark, data=data) == ([] if ok else [fv.DATA_NOT_OBJECT])


def test_business_rules(spark):
    assert errors(spark, event_type="user.signup", data='{"email":null,"source":"web"}') == []
    assert errors(spark, event_type="user.signup", data="{}") == [
        "user.signup requires data.email", "user.signup requires data.source",
    ]
    assert errors(spark, event_type="fraud.detected", data="null") == ["fraud.detected requires a data payload"]
    assert errors(spark, event_type="transaction.failed", data='{"amount":1}') == ["transaction.failed requires data.currency"]
    assert errors(spark, event_type="security.breach.attempted", data='{"ip":1,"reason":2}') == []


def test_business_rules_wait_for_field_rules(spark):
    assert errors(spark, event_type="user.signup", data="{}", user_id="no spaces") == [fv.USER_ID_FORMAT]


def test_size_counts_the_record_text(spark):
    df = events(spark, {"data": '{"a":"é"}'}).select(
        rules.event_bytes(
            F.col("event_id"), F.col("event_type"), F.col("user_id"), F.col("event_ts"), F.col("data"),
            F.create_map(F.lit("k"), F.lit("v"), F.lit("n"), F.lit(None).cast("string")), F.lit("c"), F.lit("api"), F.lit("1.0"),
        ).alias("n")
    )
    record = (
        "Event[eventId=e1, eventType=user.login, userId=u1, timestamp=2024-01-02T00:00:00Z, "
        'data={"a":"é"}, metadata={k=v, n=null}, correlationId=c, source=api, version=1.0]'
    )
    assert df.first()["n"] == len(record.encode())


def test_size_limit(spark):
    fixed = validate(fill_defaults(events(spark, {"data": '{"a":"%s"}' % ("x" * 1_048_576)})))
    message = fixed.first()["errors"]
    assert len(message) == 1 and message[0].endswith("bytes exceeds maximum 1048576 bytes (1 MB)")


def test_defaults(spark):
    row = fill_defaults(
        events(spark, {"event_id": " ", "event_ts": None}).withColumns({"version": F.lit(""), "correlation_id": F.lit(" ")})
    ).first()
    assert len(row["event_id"]) == 64 and row["correlation_id"] == row["event_id"]
    assert (row["version"], row["source"]) == ("1.0", "api") and row["event_ts"] == row["received_at"]


def test_generated_ids_repeat(spark):
    df = events(spark, {"event_id": None, "seq": 1}, {"event_id": None, "seq": 2})
    first, second = (sorted(r["event_id"] for r in fill_defaults(df).collect()) for _ in range(2))
    assert first == second and len(set(first)) == 2


@pytest.mark.parametrize(
    "kind, topic",
    [
        ("error.app", "events.critical"), ("security.x", "events.critical"), ("system.error", "events.system"),
        ("user.never_seen", "events.user"), ("a1.b_2.c", "events.raw"), ("errors.x", "events.raw"), ("", "events.raw"),
    ],
)
def test_routing(spark, kind, topic):
    assert spark.range(1).select(envelope.topic_for(F.lit(kind)).alias("t")).first()["t"] == topic


def test_outcomes_of_an_unchecked_batch(spark):
    rows = [
        {"event_id": "a"}, {"event_id": "a", "seq": 1}, {"event_id": "b", "event_type": None},
        {"event_id": "c", "event_type": "..."}, {"event_id": "b", "event_type": None, "seq": 2},
    ]
    done = ingest(events(spark, *rows).withColumn("batch_id", F.lit("x")), "batch", "none")
    found = sorted((r["event_id"], r["seq"], r["outcome"]) for r in done.outcomes.collect())
    assert found == [("a", 0, "processed"), ("a", 1, "duplicate"), ("b", 0, "failed"), ("b", 2, "duplicate"), ("c", 0, "failed")]
    assert {r["event_id"] for r in done.dead_letters.collect()} == {"b", "c"}
    assert {(r["topic"], r["key"]) for r in done.dead_letter_records.collect()} == {("events.dlq", "b"), ("events.dlq", "c")}
    tally = outcome.batch_tally(done.outcomes).first()
    assert (tally["success_count"], tally["failure_count"], tally["failed_event_ids"]) == (3, 2, ["b", "c"])
    assert done.acks.count() == 3


def test_batch_mode_checks_annotations_only(spark):
    rows = events(spark, {"event_type": "BadType"}, {"event_type": " ", "event_id": "z"}, {"event_id": "y", "seq": 1})
    batch = F.when(F.col("event_type") == "BadType", "good").otherwise("bad").alias("batch_id")
    done = ingest(rows.select("*", batch), "batch")
    assert [r["topic"] for r in done.published.collect()] == ["events.raw"]
    # One event without a type refuses its whole request.
    assert [(r["batch_id"], r["error"], r["details"]) for r in done.rejects.collect()] == [
        ("bad", "Request validation failed", ["Event type is required"])
    ]
    assert done.invalid.count() == 2


def test_batch_size_limit(spark):
    df = spark.range(2001).select((F.col("id") < 1000).alias("batch_id"))
    guarded = guard_batches(df)
    assert guarded.accepted.count() == 1000
    assert [(r["received"], r["max_size"]) for r in guarded.rejected.collect()] == [(1001, 1000)]


def test_success_rate(spark):
    pairs = spark.createDataFrame([(0, 0), (1, 3), (2, 3), (845801, 847293)], "p bigint, r bigint")
    rates = [r[0] for r in pairs.orderBy("r", "p").select(totals.success_rate(F.col("p"), F.col("r"))).collect()]
    assert rates == [100.0, 33.33, 66.67, 99.82]


def test_stats_of_nothing(spark):
    none = spark.createDataFrame([], "event_type string, outcome string, received_at timestamp")
    row = totals.stats_snapshot(none).first()
    assert (row["total_received"], row["success_rate"], row["events_by_type"], row["uptime_seconds"]) == (0, 100.0, {}, 0)


def test_decode_lines(spark):
    lines = [
        '{"eventId":"1","timestamp":"2024-01-01T00:00:00.123Z","data":{"a":1}}',
        '{"eventId":"2","timestamp":"2024-01-01T00:00:00Z"}',
        '{"eventId":"3"',
        '{"eventId":"4","data":"{\\"a\\":1}","metadata":{"k":"v"}}',
        '{"eventId":"5","data":null}',
    ]
    rows = decode_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r["malformed"] for r in rows] == [None, "timestamp", "json", None, None]
    assert rows[0]["data"] == '{"a":1}' and rows[3]["data"] == '"{\\"a\\":1}"' and rows[4]["data"] in (None, "null")
    assert rows[3]["metadata"] == {"k": "v"}


def test_decode_batches(spark):
    bodies = ['[{"eventId":"1"},{"eventId":"2"}]', '[{"eventId":"3"},{"timestamp":"x"}]', '{"eventId":"4"}', "[{"]
    rows = decode_batches(spark.createDataFrame(list(enumerate(bodies)), "id int, body string")).collect()
    assert sorted((r["id"], r["malformed"], r["event_id"]) for r in rows if r["malformed"] is None) == [(0, None, "1"), (0, None, "2")]
    assert sorted((r["id"], r["malformed"]) for r in rows if r["malformed"]) == [(1, "timestamp"), (2, "json"), (3, "json")]


def test_null_fields_option(spark):
    full = fill_defaults(events(spark, {"data": None}))
    names = ("event_id", "event_type", "user_id", "event_ts", "data", "metadata", "correlation_id", "source", "version")
    kept = envelope.wire_value(*[F.col(n) for n in names], omit_nulls=False)
    short = envelope.wire_value(*[F.col(n) for n in names])
    row = full.select(kept.alias("kept"), short.alias("short")).first()
    assert '"data":null' in row["kept"] and "data" not in row["short"]


def test_column_limits(spark):
    wide = fill_defaults(events(spark, {"event_id": "x" * 256, "user_id": "y" * 129}, {"event_id": "x" * 255}))
    assert [r["too_long"] for r in over_limits(wide).collect()] == [["event_id", "user_id", "correlation_id"]]


def test_display(spark):
    row = spark.range(1).select(
        text.thousands_rate(F.lit(5210)).alias("a"), text.grouped_number(F.lit(847293)).alias("b"),
        text.percent_text(F.lit(99.719)).alias("c"), envelope.chart_label(F.lit("analytics.page_view")).alias("d"),
        text.threshold_colour(F.lit(99.9), 99.9).alias("e"), text.threshold_colour(F.lit(99.8), 99.9).alias("f"),
    ).first()
    assert tuple(row) == ("5.2K/s", "847,293", "99.72%", "page view", "red", "green")
