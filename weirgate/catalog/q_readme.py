"""Stream-processor and analytics rows: r1-r9."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.catalog.registry import AS_OF, as_of, events, outcomes, query, wire
from weirgate.catalog.sql import outcome_sql, wire_sql
from weirgate.operators.alerts import critical_bursts
from weirgate.operators.anomaly import anomalies
from weirgate.operators.enrich import enrich, match_transactions
from weirgate.operators.rollups import estimated
from weirgate.operators.throttle import throttle
from weirgate.operators.windows import aggregate_events, windowed
from weirgate.plans.readmodel import materialise, read_model, validated
from weirgate.plans.reprocess import reprocess, still_waiting
from weirgate.session import cut_lineage, scratch_path
from weirgate.sinks.commits import CommitLog
from weirgate.sinks.tables import add_rollup, dead_letter_rows, stored_rollups
from weirgate.sources.tables import table


@query(
    "r1_tumbling_windows",
    """SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
  count(*) AS events FROM events GROUP BY ALL""",
)
def r1_tumbling(spark, sf_dir):
    return windowed(events(spark, sf_dir), "tumbling", ["event_type"], 3600, at="ts")


@query(
    "r1_sliding_windows",
    """SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS events FROM (
  SELECT time_bucket(INTERVAL 1 MINUTE, ts) - i * INTERVAL 1 MINUTE AS window_start FROM events, range(5) r(i)) GROUP BY ALL""",
)
def r1_sliding(spark, sf_dir):
    return windowed(events(spark, sf_dir), "sliding", [], 300, 60, at="ts")


@query(
    "r1_session_windows",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM s GROUP BY user_id, no""",
)
def r1_sessions(spark, sf_dir):
    return windowed(events(spark, sf_dir), "session", ["user_id"], 1800, at="ts")


@query(
    "r2_event_aggregates",
    wire_sql("""SELECT date_trunc('hour', received_at) AS window_start, event_type, count(*) AS events, count(DISTINCT user_id) AS users,
  round(sum(CAST(json_extract_string(data, '$.amount') AS DOUBLE)), 2) AS amount_sum,
  round(avg(CAST(json_extract_string(data, '$.amount') AS DOUBLE)), 4) AS amount_mean FROM wire GROUP BY 1, 2"""),
)
def r2(spark, sf_dir):
    a = aggregate_events(wire(spark, sf_dir))
    return a.withColumn("amount_sum", F.round("amount_sum", 2)).withColumn("amount_mean", F.round("amount_mean", 4))


@query(
    "r2_rollups",
    wire_sql("""SELECT unit, date_trunc(unit, received_at) AS window_start, event_type, count(*) AS events,
  round(sum(CAST(json_extract_string(data, '$.amount') AS DOUBLE)), 2) AS amount_sum,
  round(avg(CAST(json_extract_string(data, '$.amount') AS DOUBLE)), 4) AS amount_mean, TRUE AS users_near
FROM wire, (VALUES ('hour'), ('day'), ('week')) u(unit) GROUP BY 1, 2, 3"""),
)
def r2_rollups(spark, sf_dir):
    """Three increments into the stored rollups, read by hour, day and week; the estimated users stand beside the exact ones."""
    rows = wire(spark, sf_dir)
    log = CommitLog(spark, scratch_path(spark, "r2"))
    for part in range(3):
        increment = rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part)
        log.retried(lambda run, new=increment: add_rollup(run, new))
    done = None
    for unit in ("hour", "day", "week"):
        exact = rows.groupBy(F.date_trunc(unit, F.col("received_at").cast("timestamp")).alias("window_start"), "event_type").agg(
            F.count_distinct("user_id").alias("exact")
        )
        read = estimated(stored_rollups(log, unit)).withColumn("unit", F.lit(unit))
        same_type = read["event_type"].eqNullSafe(exact["event_type"]) & (read["window_start"] == exact["window_start"])
        # Three standard deviations and the rounding of the estimate.
        near = F.abs(F.col("users") - F.col("exact")) <= 0.05 * F.col("exact") + 1
        beside = read.join(exact, same_type).select(
            "unit", read["window_start"], read["event_type"], "events", F.round("amount_sum", 2).alias("amount_sum"),
            F.round("amount_mean", 4).alias("amount_mean"), near.alias("users_near"),
        )
        done = beside if done is None else done.unionByName(beside)
    return done


@query(
    "r3_enrichment",
    """SELECT event_id, event_type, user_id, c_name, c_mktsegment, c_nationkey FROM events LEFT JOIN customer ON user_id = c_custkey""",
)
def r3(spark, sf_dir):
    facts = events(spark, sf_dir).select("event_id", "event_type", "user_id")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return enrich(facts, people, F.col("user_id") == F.col("c_custkey")).drop("c_custkey")


@query(
    "r3_transaction_match",
    wire_sql("""SELECT c.user_id, c.event_id AS closed_id, o.event_id AS opened_id, c.received_at AS closed_at, o.received_at AS opened_at
FROM (SELECT * FROM wire WHERE event_type = 'transaction.completed') c
ASOF JOIN (SELECT * FROM wire WHERE event_type = 'transaction.created') o
  ON c.user_id = o.user_id AND c.received_at >= o.received_at
WHERE c.received_at - o.received_at <= INTERVAL 1 HOUR"""),
)
def r3_match(spark, sf_dir):
    return match_transactions(wire(spark, sf_dir))


@query(
    "r4_anomalies",
    f"""WITH hourly AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS c FROM events GROUP BY 1, 2),
grid AS (SELECT event_type, unnest(generate_series(min(hour), TIMESTAMP '{AS_OF}', INTERVAL 1 HOUR)) AS hour FROM hourly GROUP BY event_type),
filled AS (SELECT g.event_type, g.hour, coalesce(c, 0) AS events FROM grid g LEFT JOIN hourly h ON g.event_type = h.event_type AND g.hour = h.hour),
scored AS (SELECT *, count(*) OVER w AS hours, avg(events) OVER w AS mean, stddev_pop(events) OVER w AS deviation FROM filled
  WINDOW w AS (PARTITION BY event_type ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
SELECT event_type, hour, events, round(mean, 6) AS mean, round(deviation, 6) AS deviation,
  round(CASE WHEN deviation > 0 THEN (events - mean) / deviation END, 5) AS score,
  coalesce(abs((events - mean) / CASE WHEN deviation > 0 THEN deviation END) > 3 AND hours >= 12, FALSE) AS anomalous FROM scored""",
)
def r4(spark, sf_dir):
    a = anomalies(events(spark, sf_dir), as_of(), at="ts")
    return a.withColumns({"mean": F.round("mean", 6), "deviation": F.round("deviation", 6), "score": F.round("score", 5)})


@query(
    "r5_alerts",
    wire_sql("""SELECT DISTINCT user_id, received_at AS alert_at, n_in AS critical_events FROM (
  SELECT user_id, received_at, count(*) OVER (PARTITION BY user_id ORDER BY received_at
    RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW) AS n_in
  FROM wire WHERE event_type LIKE 'error.%' OR event_type LIKE 'security.%' OR event_type LIKE 'fraud.%') WHERE n_in >= 3"""),
)
def r5(spark, sf_dir):
    """Over four hours: the test month has no three critical events of one user in ten minutes."""
    return critical_bursts(wire(spark, sf_dir), n=3, within=4 * 3600)


_REPAIRED = "CASE WHEN n % 2 = 0 THEN 'user.login' END"


@query(
    "r6_reprocess",
    outcome_sql(f"""SELECT event_id, {_REPAIRED} AS event_type, CAST(CASE n % 3 WHEN 2 THEN 3 ELSE n % 3 + 1 END AS INTEGER) AS retry_count,
  CASE WHEN n % 3 = 2 THEN 'exhausted' WHEN n % 2 = 0 THEN 'recovered' ELSE 'failed' END AS status,
  CASE WHEN n % 3 <> 2 AND n % 2 = 0 THEN 'events.user' END AS topic FROM outcomes WHERE outcome = 'failed'"""),
)
def r6(spark, sf_dir):
    """Some payloads were repaired meanwhile, some letters have used up their tries."""
    letters = dead_letter_rows(outcomes(spark, sf_dir)).withColumn("n", F.expr("cast(substr(event_id, 5) AS bigint)"))
    waiting = letters.withColumns(
        {
            "raw_payload": F.expr(
                "CASE WHEN n % 2 = 0 THEN replace(raw_payload, '\"userId\"', '\"eventType\":\"user.login\",\"userId\"') ELSE raw_payload END"
            ),
            "retry_count": F.expr("CASE n % 3 WHEN 2 THEN 3 ELSE cast(n % 3 AS int) END"),
        }
    ).drop("n")
    return reprocess(waiting, as_of()).select("event_id", "event_type", "retry_count", "status", "topic")


@query(
    "r6_reprocess_rounds",
    outcome_sql("""SELECT event_id, CASE WHEN n % 2 = 0 THEN 'recovered' ELSE 'exhausted' END AS status,
  CASE WHEN n % 2 = 0 THEN 1 + n % 3 ELSE 3 END AS retry_count FROM outcomes WHERE outcome = 'failed'"""),
)
def r6_rounds(spark, sf_dir):
    """Four rounds over one table. Every other letter is repaired before its first, second or third round."""
    n = F.expr("cast(substr(event_id, 5) AS bigint)")
    letters = dead_letter_rows(outcomes(spark, sf_dir))
    ended = []
    for number in range(4):
        fixed = F.expr("replace(raw_payload, '\"userId\"', '\"eventType\":\"user.login\",\"userId\"')")
        ready = letters.withColumn("raw_payload", F.when((n % 2 == 0) & (n % 3 == number), fixed).otherwise(F.col("raw_payload")))
        tried = cut_lineage(reprocess(ready, as_of()))
        ended.append(tried.filter("status = 'recovered'" if number < 3 else "status <> 'failed'"))
        letters = still_waiting(tried)
    done = ended[0]
    for part in ended[1:]:
        done = done.unionByName(part)
    return done.select("event_id", "status", F.col("retry_count").cast("bigint").alias("retry_count"))


@query(
    "r6_reprocess_rules",
    outcome_sql("""SELECT event_id, CASE WHEN n % 79 = 0 OR n % 73 = 0 OR n % 61 = 0 THEN 'failed' ELSE 'recovered' END AS status,
  concat_ws('; ', CASE WHEN n % 79 = 0 THEN 'userId contains invalid characters (allowed: a-z A-Z 0-9 _ @ . -)' END,
    CASE WHEN n % 73 = 0 THEN 'timestamp drift is 25 hours — maximum allowed is 24 hours' END,
    CASE WHEN n % 61 = 0 THEN 'data must be a JSON object' END) AS reason FROM outcomes WHERE outcome = 'failed'"""),
)
def r6_rules(spark, sf_dir):
    """All payloads were repaired, but those that break a rule wait on, with the messages as their reason."""
    repaired = F.expr("replace(raw_payload, '\"userId\"', '\"eventType\":\"user.login\",\"userId\"')")
    letters = dead_letter_rows(outcomes(spark, sf_dir)).withColumn("raw_payload", repaired)
    tried = reprocess(letters, as_of(), mode="full")
    return tried.select("event_id", "status", F.when(F.col("status") == "failed", F.col("error_reason")).otherwise("").alias("reason"))


@query(
    "r7_throttle",
    wire_sql("""SELECT event_id, attempt, row_number() OVER (PARTITION BY user_id, date_trunc('day', received_at)
  ORDER BY received_at, attempt, event_id) > 2 AS throttled FROM wire"""),
)
def r7(spark, sf_dir):
    """Two events per user and day, since the test data has few events per minute."""
    return throttle(wire(spark, sf_dir), limit=2, period=86400).select("event_id", "attempt", "throttled")


@query(
    "r8_read_model",
    outcome_sql("""SELECT 'latest' AS view, user_id, arg_max(event_type, (received_at, event_id, event_type)) AS event_type, max(received_at) AS at, CAST(1 AS BIGINT) AS events
FROM outcomes WHERE outcome = 'processed' GROUP BY user_id
UNION ALL SELECT 'counts', user_id, event_type, CAST(NULL AS TIMESTAMP), count(*) FROM outcomes WHERE outcome = 'processed' GROUP BY 2, 3
UNION ALL SELECT 'hourly', CAST(NULL AS VARCHAR), event_type, date_trunc('hour', received_at), count(*) FROM outcomes
  WHERE event_type IS NOT NULL GROUP BY 3, 4"""),
)
def r8(spark, sf_dir):
    """The three views, written and read back."""
    root = scratch_path(spark, "r8")
    materialise(read_model(outcomes(spark, sf_dir)), root)
    none = F.lit(None).cast("timestamp")
    latest = spark.read.parquet(f"{root}/latest_by_user").select(
        F.lit("latest").alias("view"), "user_id", "event_type", F.col("seen_at").alias("at"), F.lit(1).cast("bigint").alias("events")
    )
    counts = spark.read.parquet(f"{root}/counts_by_user_type").select(
        F.lit("counts").alias("view"), "user_id", "event_type", none.alias("at"), "events"
    )
    hourly = spark.read.parquet(f"{root}/hourly").select(
        F.lit("hourly").alias("view"), F.lit(None).cast("string").alias("user_id"), "event_type",
        F.col("hour_bucket").alias("at"), F.col("total_count").alias("events"),
    )
    return latest.unionByName(counts).unionByName(hourly)


@query("r9_validated_view", outcome_sql("SELECT event_id, attempt, routed AS topic FROM outcomes WHERE outcome = 'processed'"))
def r9(spark, sf_dir):
    return validated(outcomes(spark, sf_dir)).select("event_id", "attempt", "topic")
