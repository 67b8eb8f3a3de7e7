"""Engine settings: one object instead of scattered constants."""

from __future__ import annotations

from dataclasses import dataclass

from weirgate import fixed_values as fv


@dataclass(frozen=True)
class Settings:
    ttl_hours: int = fv.DEDUP_TTL_HOURS
    max_drift_hours: int = fv.MAX_DRIFT_HOURS
    max_event_bytes: int = fv.MAX_EVENT_BYTES
    max_batch_rows: int = fv.MAX_BATCH_ROWS
    # A request file above this is refused by its length; its body is never read.
    max_request_bytes: int = 256 * 1024 * 1024
    # Namespace put before an event id when the seen-set is exported to a key-value store.
    dedup_key_prefix: str = "dedup:"
    # Ids with more arrivals than this never reach an array; they take the pointer walk.
    fold_limit: int = 10_000
    max_retries: int = 3
    omit_null_fields: bool = True

    @property
    def ttl_micros(self) -> int:
        return self.ttl_hours * 3_600_000_000


DEFAULTS = Settings()
