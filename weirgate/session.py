"""Session helpers: runtime SQL settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Instants are compared and rendered in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A payload that names a key twice counts with the last one.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods above this size; Spark then splits the stage instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A hot event id or user is split at run time, also below an aggregate on the same key.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rank limits up to this size are applied before the shuffle as well.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # The Python state runner talks over a socket file, not a port.
    "spark.python.unix.domain.socket.enabled": "true",
}

#: Removes the shuffle files of an execution when it ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine relies on; partition counts stay the caller's."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def tune_streaming(spark: SparkSession) -> SparkSession:
    tune(spark)
    for key, value in STREAM_CONF.items():
        if spark.conf.isModifiable(key) or key.startswith("spark.sql.streaming"):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the session names it.

    A session that names none gets a folder below the warehouse when it runs in one process (a
    local test); on a cluster that is an error, as no folder can be assumed to be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/weirgate/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise once as a table in the shared folder and go on from there.

    It survives the loss of executors, it is computed once (an RDD checkpoint computes its last
    stage twice), and the planner sees its real size. Once it is written, the shuffle files of the
    plan that made it are of no use and go at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    with setting(spark, CLEAN_SHUFFLES, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
