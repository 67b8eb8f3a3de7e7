"""Instants as epoch microseconds and buckets of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def instant(value: Column) -> Column:
    """Zone-less timestamps become UTC instants (session zone is UTC)."""
    return value.cast("timestamp")


def micros(value: Column) -> Column:
    return F.unix_micros(instant(value))


def bucket_start(value: Column, seconds: int) -> Column:
    """Start of the fixed-width bucket that holds the instant."""
    width = F.lit(seconds * MICROS)
    at = micros(value)
    return F.timestamp_micros(at - F.pmod(at, width))


def shift(value: Column, seconds: int | Column) -> Column:
    offset = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_micros(micros(value) + offset.cast("bigint") * F.lit(MICROS))
