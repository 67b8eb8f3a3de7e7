"""Dedup with a fixed time to live as keyed state.

State per id: the instant of its last admission. There is no watermark, so no row is dropped: a
late row is judged by the state like any other, and is a repeat of an admission that lies ahead.
The state of an id goes away some time after its last admission, by the clock of the machine;
that time has to cover the window and how far processing may lag behind arrival. For ids that may hold a large part
of one micro-batch use `streaming.ingest`, which runs the batch operator per micro-batch.

A call of a Python processor, its look-ups and its output cost far more than judging a row, and so does a
row on its way to Python and back. So ids are called by buckets of their hash, and the rows of a bucket that
one task reads travel as one row of arrays. The state of a bucket is a list of chunks, one for each micro-batch
that admitted something; it is only ever added to, until there are many chunks, which then become one.
"""

from __future__ import annotations

import pickle
import sys
from contextlib import contextmanager
from typing import Any, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirgate.functions.timeaxis import micros
from weirgate.settings import DEFAULTS, Settings


# The processors travel with the query, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Buckets of ids that have a state of their own. A touched bucket is read as a whole.
BUCKETS = 1 << 14

#: A bucket with that many chunks gets them merged.
CHUNKS = 64

#: Rows, and bytes of rows, that a task gathers before it packs them.
GATHERED_ROWS, GATHERED_BYTES = 1 << 20, 64 << 20

#: Rows, and about so many bytes, of one pack at most; Spark sends packs to Python ten thousand at a time.
PACK_ROWS, PACK_BYTES = 256, 16 << 10


def _packed(rows: pa.Table) -> pa.RecordBatch:
    """One row of arrays for each bucket, or some where it has many rows. The last column is the bucket."""
    rows = rows.take(np.argsort(rows.column(-1).to_numpy(), kind="stable")).combine_chunks()
    most = max(1, min(PACK_ROWS, PACK_BYTES * rows.num_rows // max(1, rows.nbytes)))
    buckets = rows.column(-1).to_numpy()
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    lengths = np.diff(starts, append=len(buckets))
    cuts = -(-lengths // most)
    # The number of each cut within its bucket.
    nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begins = np.repeat(starts, cuts) + nth * most
    offsets = pa.array(np.append(begins, len(buckets)), pa.int32())
    arrays = [pa.ListArray.from_arrays(offsets, c.chunk(0)) for c in rows.columns[:-1]]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(buckets[begins])], rows.column_names)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    n = size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
        if n >= GATHERED_ROWS or size >= GATHERED_BYTES:
            yield _packed(pa.Table.from_batches(held))
            held, n, size = [], 0, 0
    if held:
        yield _packed(pa.Table.from_batches(held))


class TtlDedup(StatefulProcessor):
    """Packs of one bucket in, the same packs and ``admitted`` out."""

    def __init__(self, columns: list[str], ttl_micros: int, kept_millis: int):
        self.columns = columns
        self.ttl = ttl_micros
        self.kept_millis = kept_millis
        self.result = Row(*columns, "admitted")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.admitted = handle.getListState("admitted", "chunk binary", self.kept_millis)

    def _stored(self, now: int) -> tuple[dict[Any, tuple[int, int]], int]:
        """The last admission of each id that is still kept, with its end, and the number of chunks."""
        stored: dict[Any, tuple[int, int]] = {}
        chunks = 0
        for (chunk,) in self.admitted.get():
            chunks += 1
            ids, ats, untils = pickle.loads(chunk)
            # Chunks come in the order they were added in, and a later admission of an id lies ahead.
            stored.update((one, (at, until)) for one, at, until in zip(ids, ats, untils) if until > now)
        return stored, chunks

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        stored, chunks = self._stored(now)
        packs = list(rows)
        if any(None in pack["_at"] for pack in packs):
            raise ValueError("a row without an instant of arrival cannot be judged")
        won = [[False] * len(pack["_at"]) for pack in packs]
        # By id: its arrivals, as (instant, number, pack, place).
        arrivals: dict[Any, list[tuple[int, int, int, int]]] = {}
        for p, pack in enumerate(packs):
            for i, (one, at, seq) in enumerate(zip(pack["event_id"], pack["_at"], pack["seq"])):
                arrivals.setdefault(one, []).append((at, seq, p, i))
        fresh = {}
        for one, line in arrivals.items():
            last = due = None
            if one in stored:
                due = stored[one][0] + self.ttl
            if len(line) > 1:
                line.sort()
            for at, _, p, i in line:
                # Of several arrivals at one instant only the first can win.
                if at != last and (due is None or at >= due):
                    won[p][i] = True
                    last, due = at, at + self.ttl
            if last is not None:
                fresh[one] = last, now + self.kept_millis
        if fresh and chunks >= CHUNKS:
            self.admitted.put([_chunk(stored | fresh)])
        elif fresh:
            self.admitted.appendValue(_chunk(fresh))
        for pack, marks in zip(packs, won):
            yield self.result(*[pack[c] for c in self.columns], marks)

    def close(self) -> None:
        pass


def _chunk(admissions: dict[Any, tuple[int, int]]) -> tuple[bytes]:
    """Ids, their last admissions and when the state of each goes away; merging chunks does not put that off.

    As bytes, because arrays are turned into the state's rows and back value by value.
    """
    ats, untils = [at for at, _ in admissions.values()], [until for _, until in admissions.values()]
    return (pickle.dumps((list(admissions), ats, untils), protocol=4),)


@contextmanager
def draining(spark: SparkSession) -> Iterator[None]:
    """State that expires by the clock would otherwise ask for empty micro-batches for ever."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stream_ttl_dedup(
    events: DataFrame, lag_hours: int = 7 * 24, settings: Settings = DEFAULTS, at: str = "received_at", buckets: int = BUCKETS
) -> DataFrame:
    """All streaming rows plus ``admitted``. Needs columns event_id, seq and ``at``.

    ``lag_hours``: how long after its arrival a row may be processed and still find the state.
    ``buckets`` stays the same for the life of a checkpoint; with far more than 50 million ids at a time
    there should be more.
    A run that drains a backlog and stops is started inside `draining`.
    """
    # The instant travels once, as a number.
    stamped = isinstance(events.schema[at].dataType, T.TimestampType)
    sent = [f for f in events.schema.fields if not (stamped and f.name == at)] + [T.StructField("_at", T.LongType())]
    names = [f.name for f in sent]
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int").alias("_bucket")
    packs = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in sent])
    marked = (
        events.withColumn("_at", micros(F.col(at)))
        .select(*[F.col(f"`{c}`") for c in names], bucket)
        .mapInArrow(_pack, T.StructType([*packs.fields, T.StructField("_bucket", T.IntegerType())]))
        .groupBy("_bucket")
        .transformWithState(
            statefulProcessor=TtlDedup(names, settings.ttl_micros, (settings.ttl_hours + lag_hours) * 3_600_000),
            outputStructType=T.StructType([*packs.fields, T.StructField("admitted", T.ArrayType(T.BooleanType()))]),
            outputMode="Append",
            timeMode="ProcessingTime",
        )
    )
    rows = marked.select(F.inline(F.arrays_zip(*[F.col(f"`{c}`") for c in names], "admitted")))
    back = F.timestamp_micros("_at").alias(at)
    return rows.select(*[back if stamped and c == at else F.col(f"`{c}`") for c in events.columns], "admitted")
