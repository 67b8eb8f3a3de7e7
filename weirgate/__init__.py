"""weirgate: event ingestion rules and event analytics as Spark DataFrame operators."""

from weirgate.plans.ingest import Ingested, ingest
from weirgate.session import tune
from weirgate.settings import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Ingested", "Settings", "ingest", "tune"]
