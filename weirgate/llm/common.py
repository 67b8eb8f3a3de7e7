"""What the operators share: tables, Arrow passes over whole texts, words and held-out folds."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.session import tune

#: Rows and bytes of one Arrow batch: texts may be long, so few rows go together.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
}
#: Separators of words in the contracts: space and \x09-\x0D, which is what bytes.split() splits on.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators; partition counts stay the caller's."""
    tune(spark)
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


#: What this worker process keeps from batch to batch: one operator's state at a time.
_HELD: dict[Hashable, object] = {}


def held(kind: str, key: Hashable, build: Callable[[], object]) -> object:
    """State that is costly to build, kept by the worker until another kind or key is asked for."""
    if (kind, key) not in _HELD:
        let_go()
        _HELD[kind, key] = build()
    return _HELD[kind, key]


def let_go(but: str | None = None) -> None:
    """Frees the state of operators other than ``but``; workers live on through later stages."""
    if any(kind != but for kind, _ in _HELD):
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def map_batches(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch],
    schema: str,
    keeps: str | None = None,
) -> DataFrame:
    """One pass over Arrow batches in the scan's own tasks; ``keeps``: the kind of state that ``work`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(but=keeps)
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    return df.mapInArrow(run, schema)


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """A column in runs of rows, with the number of the first: one row, or as many as have ``most`` bytes together."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(texts):
        before = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, before + most, side="right")))
        yield low, texts.slice(low, high - low)
        low = high


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def numbered(df: DataFrame) -> DataFrame:
    """A row number that is unique within one evaluation, so repeated and null ids stay apart."""
    return df.withColumn("row", F.monotonically_increasing_id())
