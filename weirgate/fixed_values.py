"""Values that results depend on. Change them only together with the wire contract."""

# ---- fixed values -----------------------------------------------------------

# Format patterns, matched against the whole text.
EVENT_TYPE_PATTERN = r"[a-z][a-z0-9]*(?:\.[a-z][a-z0-9_]*)+"
USER_ID_PATTERN = r"[a-zA-Z0-9_@.-]{1,128}"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Limits.
MAX_EVENT_BYTES = 1_048_576
MAX_DRIFT_HOURS = 24
MAX_BATCH_ROWS = 1000
DEDUP_TTL_HOURS = 24
STATS_PUSH_MILLIS = 2500
SCRAPE_SECONDS = 10
RATE_STEP_SECONDS = 15
CHART_POINTS = 20

# Envelope defaults.
DEFAULT_VERSION = "1.0"
DEFAULT_SOURCE = "api"

# Topics and their partition counts.
TOPIC_PARTITIONS = {
    "events.raw": 10,
    "events.user": 5,
    "events.transaction": 5,
    "events.analytics": 5,
    "events.system": 3,
    "events.critical": 3,
    "events.dlq": 1,
}
RAW_TOPIC = "events.raw"
CRITICAL_TOPIC = "events.critical"
DEAD_LETTER_TOPIC = "events.dlq"
AGGREGATE_TOPIC = "analytics.aggregated"
CATEGORY_TOPICS = {
    "user": "events.user",
    "transaction": "events.transaction",
    "analytics": "events.analytics",
    "system": "events.system",
}
CRITICAL_PREFIXES = ("error.", "security.", "fraud.")

# Event types that have business rules, with the payload fields each one needs.
KNOWN_TYPES = {
    "user.signup": ("email", "source"),
    "user.login": (),
    "user.logout": (),
    "user.profile.updated": (),
    "transaction.created": ("amount", "currency"),
    "transaction.completed": ("amount", "currency"),
    "transaction.failed": ("amount", "currency"),
    "analytics.page.view": (),
    "analytics.page_view": (),
    "analytics.button.click": (),
    "analytics.form.submit": (),
    "system.error": (),
    "system.warning": (),
    "fraud.detected": ("riskScore", "reason"),
    "security.breach.attempted": ("ip", "reason"),
}

# Messages.
EVENT_ID_REQUIRED = "eventId is required"
EVENT_TYPE_REQUIRED = "eventType is required"
EVENT_TYPE_FORMAT = (
    "eventType must be lowercase dot-separated (e.g. user.login, analytics.page.view)"
)
USER_ID_REQUIRED = "userId is required"
USER_ID_FORMAT = "userId contains invalid characters (allowed: a-z A-Z 0-9 _ @ . -)"
TIMESTAMP_REQUIRED = "timestamp is required"
DRIFT_MESSAGE = "timestamp drift is %d hours — maximum allowed is %d hours"
DATA_NOT_OBJECT = "data must be a JSON object"
SIZE_MESSAGE = "event size %d bytes exceeds maximum %d bytes (1 MB)"
FIELD_ANNOTATIONS = {
    "event_id": "Event ID is required",
    "event_type": "Event type is required",
    "user_id": "User ID is required",
    "event_ts": "Timestamp is required",
}
ACCEPTED_STATUS = "accepted"
ACCEPTED_MESSAGE = "Event queued for processing"
VALIDATION_FAILED = "Validation failed"
BATCH_TOO_LARGE = "Batch too large"
ANNOTATIONS_FAILED = "Request validation failed"
MALFORMED_BODY = "Malformed JSON request body"
INGESTION_FAILED = "Event ingestion failed — event sent to dead-letter queue"

# Column widths of the stored tables.
EVENT_COLUMN_LIMITS = {
    "event_id": 255,
    "event_type": 100,
    "user_id": 128,
    "source": 100,
    "version": 20,
    "correlation_id": 255,
}
DEAD_LETTER_COLUMN_LIMITS = {"event_id": 255, "event_type": 100, "user_id": 128}

# Panels.
LATENCY_QUANTILES = (0.5, 0.90, 0.95, 0.99)
RED_THRESHOLDS = {"throughput": 80.0, "success_rate": 99.9, "total": 100.0}

# -----------------------------------------------------------------------------
