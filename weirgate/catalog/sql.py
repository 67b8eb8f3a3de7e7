"""SQL text the oracles are built from."""

from __future__ import annotations

BASE = """base AS (
  SELECT event_id AS n, ts, user_id, event_type, value FROM events
), typed AS (
  SELECT n, ts, value,
    'evt_' || CAST(n AS STRING) AS event_id,
    CASE WHEN n % 79 = 0 THEN 'bad user!' ELSE 'user_' || CAST(user_id AS STRING) END AS user_id,
    CASE WHEN n % 83 = 0 THEN CAST(NULL AS STRING)
         WHEN n % 89 = 0 THEN 'BadType'
         WHEN n % 97 = 0 THEN 'order.shipped'
         WHEN event_type = 'click' THEN 'analytics.button.click'
         WHEN event_type = 'view' THEN CASE n % 2 WHEN 0 THEN 'analytics.page.view' ELSE 'analytics.page_view' END
         WHEN event_type = 'signup' THEN CASE n % 3 WHEN 0 THEN 'user.signup' WHEN 1 THEN 'user.login' ELSE 'user.logout' END
         WHEN event_type = 'purchase' THEN CASE n % 3 WHEN 0 THEN 'transaction.created' WHEN 1 THEN 'transaction.completed' ELSE 'transaction.failed' END
         ELSE CASE n % 5 WHEN 0 THEN 'system.error' WHEN 1 THEN 'system.warning' WHEN 2 THEN 'fraud.detected'
                         WHEN 3 THEN 'security.breach.attempted' ELSE 'error.app' END
    END AS event_type
  FROM base
), resent AS (
  SELECT *, 0 AS attempt, ts AS received_at FROM typed
  UNION ALL SELECT *, 1 AS attempt, ts + INTERVAL '20' HOUR AS received_at FROM typed WHERE n % 10 = 0
  UNION ALL SELECT *, 2 AS attempt, ts + INTERVAL '30' HOUR AS received_at FROM typed WHERE n % 20 = 0
  UNION ALL SELECT *, 3 AS attempt, ts + INTERVAL '24' HOUR AS received_at FROM typed WHERE n % 50 = 7
), wire AS (
SELECT event_id, event_type, user_id,
  CASE WHEN n % 73 = 0 THEN received_at - INTERVAL '25' HOUR
       WHEN n % 71 = 0 THEN received_at - INTERVAL '1499' MINUTE
       ELSE received_at END AS event_ts,
  CASE WHEN n % 61 = 0 THEN '[1,2]'
       WHEN n % 67 = 0 THEN CAST(NULL AS STRING)
       WHEN event_type = 'user.signup' THEN CASE n % 2 WHEN 0 THEN '{"email":null,"source":"web"}' ELSE '{"email":"a@example.com"}' END
       WHEN event_type LIKE 'transaction.%' THEN '{"amount":' || CAST(CAST(floor(value * 100) AS BIGINT) AS STRING) || ',"currency":"USD"}'
       WHEN event_type = 'fraud.detected' THEN '{"riskScore":90,"reason":"velocity"}'
       WHEN event_type = 'security.breach.attempted' THEN '{"ip":"10.0.0.1","reason":"bruteforce"}'
       ELSE '{}' END AS data,
  attempt, received_at, n
FROM resent
)"""

TOPIC = """CASE WHEN event_type IS NULL THEN NULL
  WHEN event_type LIKE 'error.%' OR event_type LIKE 'security.%' OR event_type LIKE 'fraud.%' THEN 'events.critical'
  WHEN split_part(event_type, '.', 1) = 'user' THEN 'events.user'
  WHEN split_part(event_type, '.', 1) = 'transaction' THEN 'events.transaction'
  WHEN split_part(event_type, '.', 1) = 'analytics' THEN 'events.analytics'
  WHEN split_part(event_type, '.', 1) = 'system' THEN 'events.system'
  ELSE 'events.raw' END"""


def _marks(source: str) -> str:
    return f"""hops AS (
  SELECT event_id, received_at, min(received_at) OVER (PARTITION BY event_id ORDER BY received_at
    RANGE BETWEEN INTERVAL 24 HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS next_at FROM {source}
), chain(event_id, received_at) AS (
  SELECT event_id, min(received_at) FROM {source} GROUP BY event_id
  UNION ALL
  SELECT c.event_id, h.next_at FROM chain c JOIN hops h ON c.event_id = h.event_id AND c.received_at = h.received_at
  WHERE h.next_at IS NOT NULL
), marked AS (
  SELECT w.*, c.event_id IS NOT NULL AS admitted
  FROM {source} w LEFT JOIN chain c ON w.event_id = c.event_id AND w.received_at = c.received_at
), outcomes AS (
  SELECT *, CASE WHEN NOT admitted THEN 'duplicate'
                 WHEN event_type IS NULL OR regexp_full_match(event_type, '\\.+') THEN 'failed'
                 ELSE 'processed' END AS outcome,
    {TOPIC} AS routed
  FROM marked
)"""


ERRORS = """base_errors AS (
  SELECT *, [m FOR m IN [
    CASE WHEN event_type IS NULL OR regexp_full_match(event_type, '\\s*') THEN 'eventType is required'
         WHEN NOT regexp_full_match(event_type, '[a-z][a-z0-9]*(?:\\.[a-z][a-z0-9_]*)+')
         THEN 'eventType must be lowercase dot-separated (e.g. user.login, analytics.page.view)' END,
    CASE WHEN NOT regexp_full_match(user_id, '[a-zA-Z0-9_@.-]{1,128}')
         THEN 'userId contains invalid characters (allowed: a-z A-Z 0-9 _ @ . -)' END,
    CASE WHEN abs(datesub('hour', event_ts, received_at)) > 24
         THEN 'timestamp drift is ' || abs(datesub('hour', event_ts, received_at)) || ' hours — maximum allowed is 24 hours' END,
    CASE WHEN data IS NOT NULL AND json_type(data) NOT IN ('OBJECT', 'NULL') THEN 'data must be a JSON object' END
  ] IF m IS NOT NULL] AS base FROM wire
), needs(t, field, pos) AS (VALUES
  ('user.signup', 'email', 1), ('user.signup', 'source', 2),
  ('transaction.created', 'amount', 1), ('transaction.created', 'currency', 2),
  ('transaction.completed', 'amount', 1), ('transaction.completed', 'currency', 2),
  ('transaction.failed', 'amount', 1), ('transaction.failed', 'currency', 2),
  ('fraud.detected', 'riskScore', 1), ('fraud.detected', 'reason', 2),
  ('security.breach.attempted', 'ip', 1), ('security.breach.attempted', 'reason', 2)
), business AS (
  SELECT event_id, attempt, list(message ORDER BY pos) AS found FROM (
    SELECT DISTINCT e.event_id, e.attempt,
      CASE WHEN e.data IS NULL OR json_type(e.data) = 'NULL' THEN 1 ELSE r.pos END AS pos,
      CASE WHEN e.data IS NULL OR json_type(e.data) = 'NULL' THEN e.event_type || ' requires a data payload'
           ELSE e.event_type || ' requires data.' || r.field END AS message
    FROM base_errors e JOIN needs r ON e.event_type = r.t
    WHERE len(e.base) = 0
      AND (e.data IS NULL OR json_type(e.data) = 'NULL' OR NOT list_contains(json_keys(e.data), r.field))
  ) GROUP BY event_id, attempt
), checked AS (
  SELECT e.*, CASE WHEN len(e.base) > 0 THEN e.base ELSE coalesce(b.found, CAST([] AS VARCHAR[])) END AS errors
  FROM base_errors e LEFT JOIN business b ON e.event_id = b.event_id AND e.attempt = b.attempt
)"""

BATCH = "CASE WHEN n % 3 = 0 THEN 'a' || (n // 3600) ELSE 'b' || (n // 1200) END AS batch_id"


def wire_sql(tail: str, *ctes: str) -> str:
    """A query over ``wire``."""
    return "WITH " + ", ".join([BASE, *ctes]) + "\n" + tail


def outcome_sql(tail: str, *ctes: str, before: tuple[str, ...] = (), source: str = "wire") -> str:
    """A query over ``outcomes``."""
    return "WITH RECURSIVE " + ", ".join([BASE, *before, _marks(source), *ctes]) + "\n" + tail


def checked_sql(tail: str, *ctes: str) -> str:
    """A query over ``checked``: wire events with their validation errors."""
    return "WITH " + ", ".join([BASE, ERRORS, *ctes]) + "\n" + tail


def json_text(column: str = "data") -> str:
    """The payload with its keys in sorted order."""
    return (
        f"CASE WHEN {column} = '{{\"riskScore\":90,\"reason\":\"velocity\"}}' "
        f"THEN '{{\"reason\":\"velocity\",\"riskScore\":90}}' ELSE {column} END"
    )


def millis(column: str) -> str:
    return f"date_trunc('millisecond', {column})"


def stable_hash(expression: str) -> str:
    return f"CAST('0x' || substr(md5({expression}), 1, 8) AS BIGINT)"
