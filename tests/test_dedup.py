"""Dedup against a plain loop: folds, bursts, long hot ids, increments."""

from __future__ import annotations



import pytest
from hypothesis import HealthCheck, given, settings as hyp
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirgate.operators.dedup import mark_admitted, mark_admitted_with_state, next_state
from weirgate.settings import Settings

HOUR = 3_600_000_000


def loop(rows, ttl):
    """(id, micros, seq) rows -> admitted ones."""
    last, kept = {}, set()
    for key, at, seq in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or at >= last[key] + ttl:
            last[key] = at
            kept.add((key, at, seq))
    return kept


def frame(spark, rows):
    df = spark.createDataFrame(rows, "event_id string, us bigint, seq bigint")
    return df.select("event_id", F.timestamp_micros("us").alias("received_at"), "seq", "us")


def admitted(df):
    return {(r["event_id"], r["us"], r["seq"]) for r in df.filter("admitted").collect()}


def test_documented_case(spark):
    rows = [("x", h * HOUR, i) for i, h in enumerate([0, 20, 30, 54, 77])]
    assert {us // HOUR for _, us, _ in admitted(mark_admitted(frame(spark, rows)))} == {0, 30, 54}


def test_boundary_is_admitted(spark):
    rows = [("x", 0, 0), ("x", 24 * HOUR - 1, 1), ("x", 24 * HOUR, 2)]
    assert admitted(mark_admitted(frame(spark, rows))) == {("x", 0, 0), ("x", 24 * HOUR, 2)}


def test_same_instant_admits_the_first(spark):
    rows = [("x", 0, s) for s in range(5)]
    assert admitted(mark_admitted(frame(spark, rows))) == {("x", 0, 0)}


@pytest.mark.parametrize("limit", [0, 10_000])
def test_hot_ids_take_every_way(spark, limit):
    """One id holds a third of all rows; a small limit sends it down the walk."""
    rows, n = [], 0
    for i in range(400):
        rows.append(("hot", (i * 7_919_000_000) % (20 * 24 * HOUR), n := n + 1))
        rows.append((f"a{i % 97}", (i * 31_337_000_000) % (5 * 24 * HOUR), n := n + 1))
        rows.append(("burst", (i * 13_000_000) % (3 * HOUR), n := n + 1))
    got = mark_admitted(frame(spark, rows), Settings(fold_limit=limit))
    assert got.count() == len(rows)
    assert admitted(got) == loop(rows, 24 * HOUR)


@hyp(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 200)), min_size=1, max_size=60),
    st.sampled_from([0, 1000]),
)
def test_equals_loop(spark, arrivals, limit):
    rows = [(k, h * HOUR // 2, i) for i, (k, h) in enumerate(arrivals)]
    assert admitted(mark_admitted(frame(spark, rows), Settings(fold_limit=limit))) == loop(rows, 24 * HOUR)


def test_increments_equal_one_run(spark):
    rows = [(f"k{i % 23}", (i * 9_000_000_000) % (3 * 24 * HOUR), i) for i in range(200)]
    df = frame(spark, rows)
    state = df.select("event_id", F.col("received_at").alias("admitted_at")).limit(0)
    seen = set()
    for day in range(3):
        lo, hi = day * 24 * HOUR, (day + 1) * 24 * HOUR
        marked = mark_admitted_with_state(df.filter((F.col("us") >= lo) & (F.col("us") < hi)), state)
        seen |= admitted(marked)
        state = next_state(state, marked, F.timestamp_micros(F.lit(hi)))
    assert seen == loop(rows, 24 * HOUR)


def test_state_rejects_rows_before_the_admission(spark):
    state = frame(spark, [("x", 10 * HOUR, 0)]).select("event_id", F.col("received_at").alias("admitted_at"))
    rows = frame(spark, [("x", 5 * HOUR, 1), ("x", 40 * HOUR, 2)])
    assert admitted(mark_admitted_with_state(rows, state)) == {("x", 40 * HOUR, 2)}
