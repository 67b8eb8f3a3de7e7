"""``wire_events``: the events table turned into ingest traffic (see FIXTURES.md).

One scan: resends come from an exploded array, not from a union of scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions.timeaxis import instant
from weirgate.sources.tables import table

_TYPE = """
CASE WHEN n % 83 = 0 THEN NULL
     WHEN n % 89 = 0 THEN 'BadType'
     WHEN n % 97 = 0 THEN 'order.shipped'
     WHEN kind = 'click' THEN 'analytics.button.click'
     WHEN kind = 'view' THEN CASE n % 2 WHEN 0 THEN 'analytics.page.view' ELSE 'analytics.page_view' END
     WHEN kind = 'signup' THEN CASE n % 3 WHEN 0 THEN 'user.signup' WHEN 1 THEN 'user.login' ELSE 'user.logout' END
     WHEN kind = 'purchase' THEN CASE n % 3 WHEN 0 THEN 'transaction.created'
                                            WHEN 1 THEN 'transaction.completed' ELSE 'transaction.failed' END
     ELSE CASE n % 5 WHEN 0 THEN 'system.error' WHEN 1 THEN 'system.warning' WHEN 2 THEN 'fraud.detected'
                     WHEN 3 THEN 'security.breach.attempted' ELSE 'error.app' END
END
"""
_DATA = """
CASE WHEN n % 61 = 0 THEN '[1,2]'
     WHEN n % 67 = 0 THEN NULL
     WHEN event_type = 'user.signup' THEN
       CASE n % 2 WHEN 0 THEN '{"email":null,"source":"web"}' ELSE '{"email":"a@example.com"}' END
     WHEN event_type LIKE 'transaction.%' THEN
       concat('{"amount":', cast(floor(value * 100) AS string), ',"currency":"USD"}')
     WHEN event_type = 'fraud.detected' THEN '{"riskScore":90,"reason":"velocity"}'
     WHEN event_type = 'security.breach.attempted' THEN '{"ip":"10.0.0.1","reason":"bruteforce"}'
     ELSE '{}' END
"""
_ATTEMPTS = """
concat(array(0), IF(n % 10 = 0, array(1), array()), IF(n % 20 = 0, array(2), array()), IF(n % 50 = 7, array(3), array()))
"""
_ARRIVAL = """
CASE attempt WHEN 0 THEN ts WHEN 1 THEN ts + INTERVAL '20' HOUR WHEN 2 THEN ts + INTERVAL '30' HOUR
             ELSE ts + INTERVAL '24' HOUR END
"""


def wire_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, event_type, user_id, event_ts, data, attempt, received_at, n."""
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("n"), instant(F.col("ts")).alias("ts"), "user_id",
        F.col("event_type").alias("kind"), "value",
    )
    typed = raw.select(
        "n", "ts", "value",
        F.expr("concat('evt_', cast(n AS string))").alias("event_id"),
        F.expr("CASE WHEN n % 79 = 0 THEN 'bad user!' ELSE concat('user_', cast(user_id AS string)) END").alias("user_id"),
        F.expr(_TYPE).alias("event_type"),
    )
    sent = typed.select("*", F.expr(_DATA).alias("data"), F.explode(F.expr(_ATTEMPTS)).alias("attempt"))
    arrived = sent.withColumn("received_at", F.expr(_ARRIVAL))
    return arrived.select(
        "event_id", "event_type", "user_id",
        F.expr(
            "CASE WHEN n % 73 = 0 THEN received_at - INTERVAL '25' HOUR "
            "WHEN n % 71 = 0 THEN received_at - INTERVAL '1499' MINUTE ELSE received_at END"
        ).alias("event_ts"),
        "data", "attempt", "received_at", "n",
    )
