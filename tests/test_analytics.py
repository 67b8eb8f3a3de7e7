"""Operators against brute force on small fixtures, with one hot key in each."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from weirgate.operators.alerts import critical_bursts
from weirgate.operators.enrich import match_transactions
from weirgate.operators.histogram import histogram_quantile, latency_histogram
from weirgate.operators.nearest import nearest_at_or_before
from weirgate.operators.percentiles import approx_percentiles, exact_percentiles
from weirgate.operators.rates import counter_rate, sliding_counts
from weirgate.operators.running import running_total
from weirgate.operators.throttle import throttle
from weirgate.operators.windows import sessions

MIN = 60_000_000


def traffic(spark, n=600, users=9, minutes=600, types=("error.a", "user.login"), seed=1):
    """A third of the rows belongs to one user."""
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{dice.randrange(users)}"
        rows.append((f"e{i}", dice.choice(types), user, dice.randrange(minutes) * MIN + dice.randrange(5) * 1_000_000, i))
    df = spark.createDataFrame(rows, "event_id string, event_type string, user_id string, us bigint, seq bigint")
    return rows, df.withColumn("received_at", F.timestamp_micros("us"))


def test_nearest(spark):
    dice = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"k{i % 5}", dice.randrange(-500, 500), i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, axis bigint, point boolean")
    got = nearest_at_or_before(df, ["key"], "axis", F.col("point"), ~F.col("point"), 7)
    want = {
        (k, a): max((b for k2, b, p in rows if p and k2 == k and b <= a), default=None) for k, a, p in rows if not p
    }
    assert {(r["key"], r["axis"]): r["found"] for r in got.collect()} == want


def test_bursts(spark):
    rows, df = traffic(spark)
    got = {(r["user_id"], r["us"]): r["critical_events"] for r in critical_bursts(df).withColumn("us", F.unix_micros("alert_at")).collect()}
    critical = [(u, t) for _, k, u, t, _ in rows if k == "error.a"]
    counts = {(u, t): sum(1 for u2, t2 in critical if u2 == u and t - 10 * MIN <= t2 <= t) for u, t in critical}
    assert got == {k: n for k, n in counts.items() if n >= 3} and got


def test_matches(spark):
    rows, df = traffic(spark, types=("transaction.created", "transaction.completed"))
    got = {(r["closed_id"], r["opened_id"]) for r in match_transactions(df).collect()}
    want = set()
    for e, k, u, t, _ in rows:
        if k == "transaction.completed":
            before = [(-t2, e2) for e2, k2, u2, t2, _ in rows if k2 == "transaction.created" and u2 == u and 0 <= t - t2 <= 60 * MIN]
            if before:
                want.add((e, min(before)[1]))
    assert got == want and got


def test_sessions_equal_session_windows(spark):
    _, df = traffic(spark, n=300)
    got = sessions(df, "user_id", 600).select("user_id", "session_start", "session_end", "events")
    want = df.groupBy("user_id", F.session_window("received_at", "600 seconds").alias("w")).agg(F.count("*").alias("events"))
    want = want.select("user_id", "w.start", "w.end", "events")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sliding_equals_windows(spark):
    _, df = traffic(spark, n=300)
    got = sliding_counts(df, [], {"events": F.lit(1)}, 300, 60)
    want = df.groupBy(F.window("received_at", "300 seconds", "60 seconds").alias("w")).agg(F.count("*").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("w.start", "w.end", "n").collect()))


def test_sliding_needs_whole_steps(spark):
    with pytest.raises(ValueError):
        sliding_counts(spark.range(1), [], {"n": F.lit(1)}, 100, 30)


def test_throttle(spark):
    rows, df = traffic(spark, n=400, minutes=20)
    got = {(r["event_id"], r["throttled"]) for r in throttle(df, 3).collect()}
    seen, want = {}, set()
    for e, _, u, t, s in sorted(rows, key=lambda r: (r[3], r[4])):
        seen[u, t // MIN] = seen.get((u, t // MIN), 0) + 1
        want.add((e, seen[u, t // MIN] > 3))
    assert got == want


@pytest.mark.parametrize("cells,unit", [(2, 1.0), (64, 1.0), (64, 1e-4)])
def test_percentiles(spark, cells, unit):
    dice = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"k{i % 4}", round(dice.expovariate(0.05), 2) * unit) for i in range(900)] + [("one", 7.0)]
    df = spark.createDataFrame(rows, "key string, v double")
    probs = (0.0, 0.5, 0.9, 0.95, 0.99, 1.0)
    exact = exact_percentiles(df, ["key"], "v", probs, cells)
    got = {(r["key"], r["quantile"]): r["result"] for r in exact.collect()}
    whole = df.groupBy("key").agg(F.percentile("v", F.array(*map(F.lit, probs))).alias("p")).collect()
    for row in whole:
        for p, v in zip(probs, row["p"]):
            assert got[row["key"], p] == pytest.approx(v)
    assert approx_percentiles(df, ["key"], "v", (0.5,)).count() == 6


def test_histogram_edges(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 99.0)], "key string, v double")
    cells = latency_histogram(df, ["key"], "v", (1.0, 10.0))
    assert {(r["key"], r["le"], r["cumulative"]) for r in cells.collect()} == {
        ("a", 1.0, 1), ("a", 10.0, 2), ("a", float("inf"), 2), ("b", 1.0, 0), ("b", 10.0, 0), ("b", float("inf"), 1),
    }
    assert {r["key"]: r["result"] for r in histogram_quantile(cells, ["key"], 0.75).collect()} == {"a": 5.5, "b": 10.0}
    none = cells.withColumn("cumulative", F.lit(0).cast("bigint"))
    assert {r["result"] for r in histogram_quantile(none, ["key"], 0.5).collect()} == {None}


def test_counter_rate_restart(spark):
    values = [10, 20, 5, 8]
    df = spark.createDataFrame([("s", i * 10_000_000, v) for i, v in enumerate(values)], "s string, us bigint, value bigint")
    rates = counter_rate(df.withColumn("sampled_at", F.timestamp_micros("us")), ["s"], 20).orderBy("us")
    assert [round(r["per_second"] * 20) for r in rates.collect()] == [0, 10, 15, 8]


def test_running_total(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.expr("id div 10").alias("block"), "id", F.lit(1).alias("n"))
    got = running_total(df, ["k"], "block", "id", "n", "total")
    assert {(r["id"], r["total"]) for r in got.collect()} == {(i, i // 2 + 1) for i in range(100)}
