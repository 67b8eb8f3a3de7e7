"""Columns that are worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` for costly columns that are filtered on later.

    A filter on a plain column is rewritten into its definition and pushed down, so the
    definition runs in the filter and again in the projection. It is not pushed through a
    generator; here the generator yields exactly one row per row.
    """
    entry = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(entry)))
