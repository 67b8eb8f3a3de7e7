"""Time series, listings, samples: w01-w06, o01-o02, s06."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.catalog.registry import events, outcomes, query, wire
from weirgate.catalog.sql import outcome_sql, wire_sql
from weirgate.operators.listing import chart_points, day_over_day, newest_first
from weirgate.operators.rates import counter_rate, event_rate
from weirgate.operators.running import running_total
from weirgate.operators.totals import last_non_null
from weirgate.sources.counters import counter_samples, metric_samples


def _rate_sql(keys: str, width: int, copies: int) -> str:
    group = f"{keys}, " if keys else ""
    return f"""SELECT {group}window_start, window_start + INTERVAL {width} SECOND AS window_end, count(*) AS events,
  round(count(*) / {width}.0, 6) AS per_second
FROM (SELECT {group}time_bucket(INTERVAL 15 SECOND, ts) - i * INTERVAL 15 SECOND AS window_start FROM events, range({copies}) r(i))
GROUP BY {group}window_start"""


@query("w01_event_rate", _rate_sql("", 300, 20))
def w01(spark, sf_dir):
    return event_rate(events(spark, sf_dir), [], 300, at="ts").withColumn("per_second", F.round("per_second", 6))


@query("w02_event_rate_by_type", _rate_sql("event_type", 60, 4))
def w02(spark, sf_dir):
    return event_rate(events(spark, sf_dir), ["event_type"], 60, at="ts").withColumn("per_second", F.round("per_second", 6))


_SAMPLES = """bounds AS (
  SELECT min(time_bucket(INTERVAL 10 SECOND, ts)) + INTERVAL 10 SECOND AS lo,
         max(time_bucket(INTERVAL 10 SECOND, ts)) + INTERVAL 10 SECOND AS hi FROM events
), grid AS (SELECT unnest(generate_series(lo, hi, INTERVAL 10 SECOND)) AS sampled_at FROM bounds
), cells AS (
  SELECT time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND AS sampled_at, count(*) AS c FROM events GROUP BY 1
), samples AS (
  SELECT g.sampled_at, CAST(sum(coalesce(c, 0)) OVER (ORDER BY g.sampled_at) AS BIGINT) AS value
  FROM grid g LEFT JOIN cells USING (sampled_at)
)"""


def _samples(spark, sf_dir):
    return counter_samples(events(spark, sf_dir).withColumn("metric", F.lit("events.ingested")), ["metric"], at="ts")


@query("s06_counter_samples", f"WITH {_SAMPLES} SELECT 'events.ingested' AS metric, sampled_at, value FROM samples")
def s06(spark, sf_dir):
    return _samples(spark, sf_dir)


@query(
    "s06_metric_samples",
    outcome_sql("""SELECT ts, metric, round(CASE metric WHEN 'events.ingested' THEN p WHEN 'events.failed' THEN f WHEN 'events.duplicates' THEN d
  ELSE p * 100.0 / (p + f + d) END, 6) AS value
FROM (SELECT g.ts, coalesce(sum(p) OVER w, 0) AS p, coalesce(sum(f) OVER w, 0) AS f, coalesce(sum(d) OVER w, 0) AS d FROM grid g LEFT JOIN cells c ON g.ts = c.ts
      WINDOW w AS (ORDER BY g.ts)),
  (VALUES ('events.ingested'), ('events.failed'), ('events.duplicates'), ('success.rate')) m(metric)""",
    """cells AS (SELECT time_bucket(INTERVAL 10 MINUTE, received_at) + INTERVAL 10 MINUTE AS ts,
  CAST(count(*) FILTER (WHERE outcome = 'processed') AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE outcome = 'failed') AS DOUBLE) AS f,
  CAST(count(*) FILTER (WHERE outcome = 'duplicate') AS DOUBLE) AS d FROM outcomes GROUP BY 1),
grid AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 10 MINUTE)) AS ts FROM cells)"""),
)
def s06_metrics(spark, sf_dir):
    """Sampled every ten minutes."""
    samples = metric_samples(outcomes(spark, sf_dir), interval=600)
    return samples.select("ts", "metric", F.round("value", 6).alias("value"))


@query(
    "w03_counter_rate",
    f"""WITH {_SAMPLES}, restarted AS (
  SELECT sampled_at, value % 1000 AS value FROM samples
), ups AS (
  SELECT *, lag(value) OVER (ORDER BY sampled_at) AS before FROM restarted)
SELECT 'events.ingested' AS metric, sampled_at, value, round(sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END)
  OVER (ORDER BY sampled_at RANGE BETWEEN INTERVAL 299 SECOND PRECEDING AND CURRENT ROW) / 300.0, 6) AS per_second FROM ups""",
)
def w03(spark, sf_dir):
    """A counter that restarts from zero after every thousand events."""
    restarting = _samples(spark, sf_dir).withColumn("value", F.col("value") % 1000)
    return counter_rate(restarting, ["metric"]).withColumn("per_second", F.round("per_second", 6))


@query(
    "w04_cumulative_counters",
    outcome_sql("""SELECT outcome, minute, CAST(sum(c) OVER (PARTITION BY outcome ORDER BY minute) AS BIGINT) AS total FROM (
  SELECT outcome, date_trunc('minute', received_at) AS minute, count(*) AS c FROM outcomes GROUP BY 1, 2)"""),
)
def w04(spark, sf_dir):
    per_minute = outcomes(spark, sf_dir).groupBy(
        "outcome", F.date_trunc("day", "received_at").alias("day"), F.date_trunc("minute", "received_at").alias("minute")
    ).agg(F.count(F.lit(1)).alias("c"))
    return running_total(per_minute, ["outcome"], "day", "minute", "c", "total")


@query(
    "w05_chart_points",
    """SELECT time_bucket(INTERVAL 15 SECOND, ts) AS point_at, count(*) AS events, round(avg(value), 6) AS latency
FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 20""",
)
def w05(spark, sf_dir):
    return chart_points(events(spark, sf_dir), "value", 15, at="ts").withColumn("latency", F.round("latency", 6))


@query(
    "w06_day_over_day",
    """WITH daily AS (SELECT event_type, date_trunc('day', ts) AS day, count(*) AS c FROM events GROUP BY 1, 2),
grid AS (SELECT event_type, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM daily GROUP BY event_type),
filled AS (SELECT g.event_type, g.day, coalesce(c, 0) AS events FROM grid g LEFT JOIN daily d ON g.event_type = d.event_type AND g.day = d.day)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, events, round(CASE WHEN lag(events) OVER w > 0
  THEN (events - lag(events) OVER w) * 100.0 / lag(events) OVER w END, 6) AS change_percent
FROM filled WINDOW w AS (PARTITION BY event_type ORDER BY day)""",
)
def w06(spark, sf_dir):
    d = day_over_day(events(spark, sf_dir), ["event_type"], at="ts")
    return d.select("event_type", F.col("day").cast("string").alias("day"), "events", F.round("change_percent", 6).alias("change_percent"))


@query(
    "o01_newest_first",
    wire_sql("""SELECT event_id, event_type, user_id, received_at AS created_at FROM wire
ORDER BY received_at DESC, event_id LIMIT 50"""),
)
def o01(spark, sf_dir):
    rows = wire(spark, sf_dir).select("event_id", "event_type", "user_id", F.col("received_at").alias("created_at"))
    return newest_first(rows, 50)


@query(
    "o02_last_non_null",
    """SELECT user_id, arg_max(v, ts) AS last_value, max(ts) AS last_at
FROM (SELECT user_id, ts, CASE WHEN event_type <> 'error' THEN value END AS v FROM events) WHERE v IS NOT NULL GROUP BY user_id""",
)
def o02(spark, sf_dir):
    gappy = events(spark, sf_dir).select("user_id", "ts", F.expr("CASE WHEN event_type <> 'error' THEN value END").alias("v"))
    return last_non_null(gappy, ["user_id"], "ts", "v")
