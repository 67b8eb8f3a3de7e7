"""Envelope defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate import fixed_values as fv
from weirgate.functions.text import default_if_blank, is_blank
from weirgate.functions.timeaxis import instant

OPTIONAL = {
    "data": "string",
    "metadata": "map<string,string>",
    "correlation_id": "string",
    "source": "string",
    "version": "string",
}


def with_optional_columns(df: DataFrame) -> DataFrame:
    """Add the envelope columns that the input does not carry, as nulls."""
    missing = {n: F.lit(None).cast(t) for n, t in OPTIONAL.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def generated_id(*identity: Column) -> Column:
    """A replay gives the same id, unlike a random UUID."""
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in identity]), 256)


def numbered_lines(df: DataFrame) -> DataFrame:
    """``seq``, the arrival number, and for rows without an id ``copy``: the how manieth of equal lines of a file it is.

    Equal lines (``batch_id`` and ``line``, a hash) are interchangeable, so their numbers, and ids made of
    them, are the same however the file was split. They are counted within the pieces they were read in
    first, and then over the pieces, so a line that makes up most of a file is in no single task.
    """
    rows = df.withColumns({"seq": F.monotonically_increasing_id(), "_piece": F.spark_partition_id()})
    if not {"batch_id", "line"} <= set(df.columns):
        return rows.drop("_piece")
    blank = is_blank(F.col("event_id"))
    unnamed = rows.filter(blank)
    line = Window.partitionBy("batch_id", "line")
    inside = F.row_number().over(Window.partitionBy("batch_id", "line", "_piece").orderBy("seq"))
    pieces = unnamed.groupBy("batch_id", "line", "_piece").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(line.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select("batch_id", "line", "_piece", before.alias("before"))
    counted = unnamed.withColumn("inside", inside).join(pieces, ["batch_id", "line", "_piece"])
    counted = counted.withColumn("copy", F.col("before") + F.col("inside")).drop("before", "inside", "_piece")
    # Rows with an id, nearly all of them, stay where they are.
    return rows.filter(~blank).withColumn("copy", F.lit(None).cast("bigint")).drop("_piece").unionByName(counted)


def fill_defaults(df: DataFrame, identity: tuple[str, ...] | None = None) -> DataFrame:
    """Blank id, timestamp, version, source and correlation id get their defaults.

    ``identity`` names columns that identify the row in its input: its file, its line and the number among
    equal ones where the reader tells them, else its file and arrival number. Without any, ids are random.
    """
    if identity is None:
        identity = ("batch_id", "line", "copy") if "line" in df.columns else ("batch_id", "seq")
    known = [F.col(c) for c in identity if c in df.columns]
    fresh = generated_id(*known) if known else F.uuid()
    full = with_optional_columns(df)
    with_id = full.withColumn("event_id", default_if_blank(F.col("event_id"), fresh))
    return with_id.withColumns(
        {
            "event_ts": F.coalesce(instant(F.col("event_ts")), instant(F.col("received_at"))),
            "version": default_if_blank(F.col("version"), F.lit(fv.DEFAULT_VERSION)),
            "source": default_if_blank(F.col("source"), F.lit(fv.DEFAULT_SOURCE)),
            "correlation_id": default_if_blank(F.col("correlation_id"), F.col("event_id")),
        }
    )


def create_events(df: DataFrame, identity: tuple[str, ...] | None = None) -> DataFrame:
    """Whole events from (event_type, user_id, data) rows plus their arrival columns."""
    bare = df.withColumns(
        {
            "event_id": F.lit(None).cast("string"),
            "event_ts": F.lit(None).cast("timestamp"),
            "version": F.lit(None).cast("string"),
            "source": F.lit(None).cast("string"),
            "correlation_id": F.lit(None).cast("string"),
        }
    )
    return fill_defaults(bare, identity)
