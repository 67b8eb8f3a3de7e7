"""Validation of whole rows and of whole batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.functions import rules
from weirgate.operators.normalise import with_optional_columns
from weirgate.operators.once import computed_once
from weirgate.settings import DEFAULTS, Settings

MODES = ("full", "annotations", "none")
_COLUMNS = (
    "event_id", "event_type", "user_id", "event_ts", "data",
    "metadata", "correlation_id", "source", "version", "received_at",
)


def validate(df: DataFrame, mode: str = "full", settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``errors``: ordered messages, empty for a valid row.

    ``full`` runs the field rules and, when none of them fails, the business rules.
    ``annotations`` checks only that the required fields are there. ``none`` accepts all.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "none":
        return df.withColumn("errors", F.array().cast("array<string>"))
    if mode == "annotations":
        return df.withColumn(
            "errors", rules.annotation_rules(*[F.col(c) for c in ("event_id", "event_type", "user_id", "event_ts")])
        )
    full = with_optional_columns(df)
    columns = {name: F.col(name) for name in _COLUMNS}
    # The payload is parsed once, and the metadata map is measured in a projection of its own,
    # because its lambda cannot be compiled and would slow the rules down with it.
    staged = full.withColumn("_map", rules.metadata_length(F.col("metadata")))
    staged = staged.withColumn("_keys", F.json_object_keys("data"))
    fields = {name: column for name, column in columns.items() if name != "received_at"}
    size = rules.event_bytes(**fields, map_length=F.col("_map"))
    staged = staged.withColumn("_base", rules.base_rules(columns, F.col("_keys"), size, settings))
    errors = F.when(F.size("_base") > 0, F.col("_base")).otherwise(
        rules.business_rules(F.col("event_type"), F.col("data"), F.col("_keys"))
    )
    return computed_once(staged, errors=errors).select(*df.columns, "errors")


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.size("errors") == 0)


def invalid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.size("errors") > 0)


def batch_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("received"))


def oversized_batches(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per batch that is rejected as a whole.

    Decoded requests carry their ``batch_size``, so no counting is needed for them.
    """
    if {"batch_size", "position"} <= set(df.columns):
        sizes = df.filter(F.col("position") == 0).select("batch_id", F.col("batch_size").cast("bigint").alias("received"))
    else:
        sizes = batch_sizes(df)
    return sizes.filter(F.col("received") > settings.max_batch_rows).select(
        "batch_id",
        F.lit(fv.BATCH_TOO_LARGE).alias("error"),
        F.lit(settings.max_batch_rows).alias("max_size"),
        "received",
    )


def accepted_batches(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows of the batches within the size limit.

    Counting combines before the shuffle. Rows are matched against the oversized ids only;
    Spark broadcasts those when their measured size allows it and splits hot batches otherwise.
    """
    if {"batch_size", "position"} <= set(df.columns):
        return df.filter(F.col("batch_size") <= settings.max_batch_rows)
    return df.join(oversized_batches(df, settings).select("batch_id"), "batch_id", "left_anti")
