"""Aggregations: a01-a16."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.catalog.registry import AS_OF, as_of, events, outcomes, query, wire
from weirgate.catalog.sql import checked_sql, outcome_sql
from weirgate.operators import totals as t
from weirgate.operators.histogram import DEFAULT_BOUNDS, histogram_quantile, latency_histogram, rolling_histogram_quantile
from weirgate.operators.normalise import fill_defaults
from weirgate.operators.percentiles import approx_percentiles, exact_percentiles
from weirgate.operators.rates import rolling_success
from weirgate.operators.validation import validate
from weirgate.sources.counters import counter_samples

_SUMS = """count(*) AS total_received, count(*) FILTER (WHERE outcome = 'processed') AS total_processed,
  count(*) FILTER (WHERE outcome = 'failed') AS total_failed, count(*) FILTER (WHERE outcome = 'duplicate') AS total_duplicated"""


@query("a01_totals", outcome_sql(f"SELECT {_SUMS} FROM outcomes"))
def a01(spark, sf_dir):
    return t.totals(outcomes(spark, sf_dir))


@query(
    "a02_processed_by_type",
    outcome_sql("SELECT event_type, count(*) AS events FROM outcomes WHERE outcome = 'processed' GROUP BY event_type"),
)
def a02(spark, sf_dir):
    return t.processed_by_type(outcomes(spark, sf_dir))


@query(
    "a03_success_rate",
    outcome_sql("""SELECT floor(count(*) FILTER (WHERE outcome = 'processed') * 10000.0 / count(*) + 0.5) / 100 AS success_rate
FROM outcomes"""),
)
def a03(spark, sf_dir):
    s = t.totals(outcomes(spark, sf_dir))
    return s.select(t.success_rate(F.col("total_processed"), F.col("total_received")).alias("success_rate"))


@query(
    "a04_success_gauge",
    outcome_sql("""SELECT event_type, round(count(*) FILTER (WHERE outcome = 'processed') * 100.0 / count(*), 6) AS success_gauge
FROM outcomes GROUP BY event_type"""),
)
def a04(spark, sf_dir):
    s = t.totals(outcomes(spark, sf_dir), ["event_type"])
    gauge = t.success_gauge(F.col("total_processed"), F.col("total_received"))
    return s.select("event_type", F.round(gauge, 6).alias("success_gauge"))


@query(
    "a05_stats_snapshot",
    outcome_sql(f"""SELECT s.*, b.event_type, b.events FROM (
  SELECT {_SUMS}, floor(count(*) FILTER (WHERE outcome = 'processed') * 10000.0 / count(*) + 0.5) / 100 AS success_rate,
    datesub('second', min(received_at), max(received_at)) AS uptime_seconds FROM outcomes) s,
  (SELECT event_type, count(*) AS events FROM outcomes WHERE outcome = 'processed' GROUP BY event_type) b"""),
)
def a05(spark, sf_dir):
    """The one-row snapshot with its map opened to rows."""
    return t.stats_snapshot(outcomes(spark, sf_dir)).select(
        "total_received", "total_processed", "total_failed", "total_duplicated", "success_rate", "uptime_seconds",
        F.explode("events_by_type").alias("event_type", "events"),
    )


@query(
    "a06_uptime",
    "SELECT event_type, datesub('second', min(ts), max(ts)) AS uptime_seconds FROM events GROUP BY event_type",
)
def a06(spark, sf_dir):
    span = t.uptime_seconds(F.min(F.col("ts").cast("timestamp")), F.max(F.col("ts").cast("timestamp")))
    return events(spark, sf_dir).groupBy("event_type").agg(span.alias("uptime_seconds"))


@query("a07_stream_accept_count", checked_sql("SELECT count(*) FILTER (WHERE len(errors) = 0) AS processed_events FROM checked"))
def a07(spark, sf_dir):
    return t.accepted_count(validate(fill_defaults(wire(spark, sf_dir))))


_Q = "CAST([0.5, 0.9, 0.95, 0.99] AS DOUBLE[])"


@query(
    "a08_latency_percentiles",
    f"""SELECT event_type, unnest({_Q}) AS quantile, round(unnest(quantile_cont(value, [0.5, 0.9, 0.95, 0.99])), 6) AS result
FROM events GROUP BY event_type""",
)
def a08(spark, sf_dir):
    p = exact_percentiles(events(spark, sf_dir), ["event_type"], "value", fv.LATENCY_QUANTILES)
    return p.select("event_type", "quantile", F.round("result", 6).alias("result"))


@query(
    "a08_latency_percentiles_approx",
    f"SELECT event_type, unnest({_Q}) AS quantile, TRUE AS within_error FROM events GROUP BY event_type",
)
def a08_approx(spark, sf_dir):
    """The sketch's answers, with their true ranks checked against its error bound."""
    rows = events(spark, sf_dir)
    answers = approx_percentiles(rows, ["event_type"], "value", fv.LATENCY_QUANTILES, accuracy=10_000)
    wide = answers.groupBy("event_type").pivot("quantile", list(fv.LATENCY_QUANTILES)).agg(F.first("result"))
    named = wide.toDF("event_type", *[f"r{i}" for i in range(len(fv.LATENCY_QUANTILES))])
    counts = [F.count(F.lit(1)).alias("n")]
    for i in range(len(fv.LATENCY_QUANTILES)):
        counts.append(F.count_if(F.col("value") < F.col(f"r{i}")).alias(f"below{i}"))
        counts.append(F.count_if(F.col("value") <= F.col(f"r{i}")).alias(f"upto{i}"))
    ranked = rows.select("event_type", "value").join(named, "event_type").groupBy("event_type").agg(*counts)
    slack = F.col("n") / F.lit(10_000.0) + F.lit(1)
    checks = [
        F.struct(
            F.lit(q).alias("quantile"),
            ((F.col(f"below{i}") <= q * F.col("n") + slack) & (F.col(f"upto{i}") >= q * F.col("n") - slack)).alias("within_error"),
        )
        for i, q in enumerate(fv.LATENCY_QUANTILES)
    ]
    return ranked.select("event_type", F.inline(F.array(*checks)))


_BOUNDS = ", ".join(str(b) for b in DEFAULT_BOUNDS)
_HIST = f"""bounds AS (SELECT unnest([{_BOUNDS}, CAST('Infinity' AS DOUBLE)]) AS le), hist AS (
  SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS cumulative FROM events, bounds GROUP BY event_type, le)"""


@query("a09_latency_histogram", f"WITH {_HIST} SELECT event_type, CAST(le AS VARCHAR) AS le, cumulative FROM hist")
def a09(spark, sf_dir):
    h = latency_histogram(events(spark, sf_dir), ["event_type"], "value")
    text = F.when(F.col("le") == F.lit(float("inf")), F.lit("inf")).otherwise(F.col("le").cast("string"))
    return h.withColumn("le", text)


@query(
    "a10_histogram_quantile",
    f"""WITH {_HIST}, ranked AS (
  SELECT *, lag(cumulative, 1, 0) OVER w AS below, lag(le, 1, 0.0) OVER w AS floor_le,
    0.99 * max(cumulative) OVER (PARTITION BY event_type) AS rank
  FROM hist WINDOW w AS (PARTITION BY event_type ORDER BY le)
), hit AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS pick FROM ranked WHERE cumulative >= rank)
SELECT event_type, round(CASE WHEN le = CAST('Infinity' AS DOUBLE) THEN floor_le
  ELSE floor_le + (le - floor_le) * (rank - below) / (cumulative - below) END, 6) AS result FROM hit WHERE pick = 1""",
)
def a10(spark, sf_dir):
    buckets = latency_histogram(events(spark, sf_dir), ["event_type"], "value")
    return histogram_quantile(buckets, ["event_type"], 0.99).select("event_type", F.round("result", 6).alias("result"))


@query(
    "a10_rolling_p99",
    f"""WITH bounds AS (SELECT unnest([{_BOUNDS}, CAST('Infinity' AS DOUBLE)]) AS le), spread AS (
  SELECT value, time_bucket(INTERVAL 15 SECOND, ts) - i * INTERVAL 15 SECOND AS window_start FROM events, range(20) r(i)
), hist AS (
  SELECT window_start, le, count(*) FILTER (WHERE value <= le) AS cumulative FROM spread, bounds GROUP BY window_start, le
), ranked AS (
  SELECT *, lag(cumulative, 1, 0) OVER w AS below, lag(le, 1, 0.0) OVER w AS floor_le,
    0.99 * max(cumulative) OVER (PARTITION BY window_start) AS rank
  FROM hist WINDOW w AS (PARTITION BY window_start ORDER BY le)
), hit AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY le) AS pick FROM ranked WHERE cumulative >= rank)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
  round(CASE WHEN le = CAST('Infinity' AS DOUBLE) THEN floor_le
  ELSE floor_le + (le - floor_le) * (rank - below) / (cumulative - below) END, 6) AS result FROM hit WHERE pick = 1""",
)
def a10_rolling(spark, sf_dir):
    p99 = rolling_histogram_quantile(events(spark, sf_dir), "value", 0.99, at="ts")
    return p99.withColumn("result", F.round("result", 6))


@query(
    "a11_hourly_metrics",
    outcome_sql("""SELECT date_trunc('hour', received_at) AS hour_bucket, event_type, count(*) AS total_count,
  count(*) FILTER (WHERE outcome = 'processed') AS success_count, count(*) FILTER (WHERE outcome = 'failed') AS failure_count
FROM outcomes WHERE event_type IS NOT NULL GROUP BY 1, 2"""),
)
def a11(spark, sf_dir):
    return t.hourly_metrics(outcomes(spark, sf_dir))


@query("a12_series_sum", "SELECT CAST(count(*) AS BIGINT) AS total FROM events")
def a12(spark, sf_dir):
    samples = counter_samples(events(spark, sf_dir), ["event_type"], at="ts", interval=3600)
    return t.series_sum(samples, ["event_type"], "sampled_at", "value")


@query(
    "a13_failed_share",
    outcome_sql("""SELECT date_trunc('day', received_at) AS day,
  round(count(*) FILTER (WHERE outcome = 'failed') * 100.0 / count(*), 6) AS failed_percent FROM outcomes GROUP BY 1"""),
)
def a13(spark, sf_dir):
    s = t.totals(outcomes(spark, sf_dir).withColumn("day", F.date_trunc("day", "received_at")), ["day"])
    return s.select("day", F.round(t.failed_share(F.col("total_failed"), F.col("total_received")), 6).alias("failed_percent"))


@query(
    "a14_rolling_success",
    outcome_sql("""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
  count(*) FILTER (WHERE outcome = 'processed') AS good, count(*) AS events,
  round(count(*) FILTER (WHERE outcome = 'processed') * 100.0 / count(*), 6) AS success_percent
FROM (SELECT outcome, time_bucket(INTERVAL 15 SECOND, received_at) - i * INTERVAL 15 SECOND AS window_start
      FROM outcomes, range(20) r(i)) GROUP BY window_start"""),
)
def a14(spark, sf_dir):
    r = rolling_success(outcomes(spark, sf_dir))
    return r.withColumn("success_percent", F.round("success_percent", 6))


@query(
    "a15_load_tally",
    outcome_sql("""SELECT user_id, ok, failed, elapsed_seconds, (ok + failed) // elapsed_seconds AS events_per_second FROM (
  SELECT user_id, count(*) FILTER (WHERE outcome <> 'failed') AS ok, count(*) FILTER (WHERE outcome = 'failed') AS failed,
    greatest(datesub('second', min(received_at), max(received_at)), 1) AS elapsed_seconds FROM outcomes GROUP BY user_id)"""),
)
def a15(spark, sf_dir):
    return t.load_tally(outcomes(spark, sf_dir), ["user_id"])


_FRESH = f"""fresh AS (SELECT coalesce(CASE WHEN outcome = 'processed' THEN routed END, 'events.dlq') AS topic,
  max(received_at) AS last_seen, count(*) AS events FROM outcomes WHERE outcome <> 'duplicate' GROUP BY 1),
judged AS (SELECT *, CASE WHEN last_seen >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR THEN 'UP' ELSE 'DOWN' END AS status FROM fresh)"""


@query(
    "a16_freshness",
    outcome_sql(
        """SELECT topic, last_seen, events, status FROM judged
UNION ALL SELECT 'all', max(last_seen), CAST(sum(events) AS BIGINT), CASE WHEN bool_and(status = 'UP') THEN 'UP' ELSE 'DOWN' END FROM judged""",
        _FRESH,
    ),
)
def a16(spark, sf_dir):
    topics = t.freshness(outcomes(spark, sf_dir), as_of(), 6 * 3600)
    last = topics.agg(F.max("last_seen").alias("last_seen"))
    overall = t.overall_health(topics)
    # Two one-row results side by side, by a constant key.
    joined = overall.withColumn("k", F.lit(1)).join(last.withColumn("k", F.lit(1)), "k")
    return topics.unionByName(joined.select(F.lit("all").alias("topic"), "last_seen", "events", "status"))
