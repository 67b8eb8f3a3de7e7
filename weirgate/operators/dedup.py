"""Dedup with a fixed time to live.

The first arrival of an id is admitted and opens a window of ``ttl``; arrivals inside it are
duplicates and do not extend it; the first arrival at or after its end is admitted and opens
the next one.

Ids that arrive once, nearly all of them, need nothing but a count. For the others it depends
on their arrivals:

* up to ``fold_limit``: an array fold per id, bounded by that limit;
* more, but all within one window: everything after the first arrival is a duplicate;
* more, over several windows: every instant points to the first instant at least ``ttl``
  later, and the chain from the first arrival is followed by pointer doubling. Its joins are
  on (id, instant), so the hot id is spread over the cluster.

The result is built from the duplicates, the smaller side, and not from the admissions. Rows with
the same id, instant and ``seq`` are one key; of an admitted key exactly one row is admitted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.functions.timeaxis import micros
from weirgate.operators.nearest import nearest_at_or_before
from weirgate.session import cut_lineage
from weirgate.settings import DEFAULTS, Settings

# Slice of one id's time line handled by one window group.
SLICE_MICROS = 60_000_000


def _repeated(rows: DataFrame) -> DataFrame:
    """Ids with more than one arrival. Whole numbers only, so the aggregate hashes."""
    return (
        rows.groupBy("event_id")
        .agg(
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.count(F.lit(1)).alias("arrivals"),
        )
        .filter(F.col("arrivals") > 1)
    )


def _of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.select("event_id"), "event_id", "left_semi")


def _kept(arrivals: Column, ttl: int) -> Column:
    """The arrivals that are at least ``ttl`` after the last kept one."""
    none = F.filter(arrivals, lambda x: F.lit(False))

    def step(kept: Column, x: Column) -> Column:
        due = F.element_at(kept, -1)["at"] + F.lit(ttl)
        return F.when((F.size(kept) == 0) | (x["at"] >= due), F.concat(kept, F.array(x))).otherwise(kept)

    return F.aggregate(arrivals, none, step)


def _fold(rows: DataFrame, ttl: int) -> DataFrame:
    """Keys that are not admitted (``repeat``), and admitted keys that several rows share."""
    lined = rows.groupBy("event_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "seq"))).alias("arrivals")
    ).withColumn("kept", _kept(F.col("arrivals"), ttl))
    # Sorted, so rows of one key are neighbours.
    shared = F.filter("arrivals", lambda x, i: (i > 0) & (x == F.get(F.col("arrivals"), i - 1)))

    def noted(keys: Column, repeat: bool) -> Column:
        return F.transform(keys, lambda x: F.struct(x["at"], x["seq"], F.lit(repeat).alias("repeat")))

    found = F.concat(
        noted(F.array_except("arrivals", "kept"), True), noted(F.array_intersect(shared, "kept"), False)
    )
    return lined.select("event_id", F.explode(found).alias("x")).select("event_id", "x.at", "x.seq", "x.repeat")


def _first_arrivals(rows: DataFrame) -> DataFrame:
    """One row per id, combined before the shuffle however many arrivals it has."""
    return rows.groupBy("event_id").agg(F.min(F.struct("at", "seq")).alias("x")).select(
        "event_id", "x.at", "x.seq"
    )


def _walk_admissions(rows: DataFrame, ids: DataFrame, ttl: int) -> DataFrame:
    """Admissions of ids with very many arrivals over several windows, by pointer doubling."""
    instants = cut_lineage(rows.groupBy("event_id", "at").agg(F.min("seq").alias("seq")))
    # "First at or after" is "latest at or before" on the mirrored axis.
    sides = F.array(
        F.struct((-F.col("at")).alias("axis"), F.lit(True).alias("is_point")),
        F.struct((-(F.col("at") + F.lit(ttl))).alias("axis"), F.lit(False).alias("is_point")),
    )
    marks = instants.select("event_id", F.explode(sides).alias("m")).select("event_id", "m.axis", "m.is_point")
    mirrored = nearest_at_or_before(
        marks, ["event_id"], "axis", F.col("is_point"), ~F.col("is_point"), SLICE_MICROS
    )
    hops = cut_lineage(
        mirrored.filter("found IS NOT NULL").select(
            "event_id", (-F.col("axis") - F.lit(ttl)).alias("at"), (-F.col("found")).alias("next_at")
        )
    )
    longest = ids.agg(F.max(F.col("last_at") - F.col("first_at"))).first()[0]
    rounds = math.ceil(math.log2(longest // ttl + 1))
    reached = ids.select("event_id", F.col("first_at").alias("at"))
    for done in range(rounds):
        step = reached.join(hops, ["event_id", "at"]).select("event_id", F.col("next_at").alias("at"))
        reached = cut_lineage(reached.unionByName(step))
        if done + 1 < rounds:
            onward = hops.select("event_id", F.col("at").alias("next_at"), F.col("next_at").alias("further"))
            hops = cut_lineage(
                hops.join(onward, ["event_id", "next_at"]).select(
                    "event_id", "at", F.col("further").alias("next_at")
                )
            )
    return reached.join(instants, ["event_id", "at"]).select("event_id", "at", "seq")


def _hot(rows: DataFrame, ids: DataFrame, ttl: int) -> DataFrame:
    one_window = F.col("last_at") - F.col("first_at") < ttl
    burst, long = ids.filter(one_window), ids.filter(~one_window)
    admitted = _first_arrivals(_of(rows, burst))
    if not long.isEmpty():
        admitted = admitted.unionByName(_walk_admissions(_of(rows, long), long, ttl))
    keys = _of(rows, ids).groupBy("event_id", "at", "seq").agg(F.count(F.lit(1)).alias("rows"))
    judged = keys.join(admitted.withColumn("won", F.lit(True)), ["event_id", "at", "seq"], "left")
    return judged.filter("won IS NULL OR rows > 1").select("event_id", "at", "seq", F.col("won").isNull().alias("repeat"))


def _rows(df: DataFrame, at: str, seq: str) -> DataFrame:
    return df.select("event_id", micros(F.col(at)).alias("at"), F.col(seq).alias("seq"))


def _notable(rows: DataFrame, settings: Settings) -> DataFrame:
    """Keys that are not admitted (``repeat``), and admitted keys that several rows share; one row each.

    The ids with repeats are materialised once: what they look like decides which ways are needed.
    """
    ttl = settings.ttl_micros
    repeated = cut_lineage(_repeated(rows))
    few = repeated.filter(F.col("arrivals") <= settings.fold_limit)
    many = repeated.filter(F.col("arrivals") > settings.fold_limit)
    notable = _fold(_of(rows, few), ttl)
    if not many.isEmpty():
        notable = notable.unionByName(_hot(rows, many, ttl))
    return cut_lineage(notable)


def ttl_duplicates(
    df: DataFrame, settings: Settings = DEFAULTS, at: str = "received_at", seq: str = "seq"
) -> DataFrame:
    """(event_id, at, seq) of every key that is not admitted, once; ``at`` in epoch microseconds."""
    return _notable(_rows(df, at, seq), settings).filter("repeat").drop("repeat")


def _mark(df: DataFrame, notable: DataFrame, at: str, seq: str) -> DataFrame:
    """All rows plus ``admitted``. The join key is one row wide, so no id is hot in it.

    Rows that share an admitted key are one arrival that came several times: one of them is
    admitted. Only those rows are numbered.
    """
    keys = ["event_id", "_at", seq]
    noted = notable.select("event_id", F.col("at").alias("_at"), F.col("seq").alias(seq), F.col("repeat").alias("_repeat"))
    joined = df.withColumn("_at", micros(F.col(at))).join(noted, keys, "left")
    columns = [F.col(c) for c in df.columns]
    if notable.filter("NOT repeat").isEmpty():
        return joined.select(*columns, F.col("_repeat").isNull().alias("admitted"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(seq)) == 1
    shared = joined.filter("NOT _repeat").select(*columns, first.alias("admitted"))
    rest = joined.filter("_repeat IS NULL OR _repeat").select(*columns, F.col("_repeat").isNull().alias("admitted"))
    return rest.unionByName(shared)


def mark_admitted(
    df: DataFrame, settings: Settings = DEFAULTS, at: str = "received_at", seq: str = "seq"
) -> DataFrame:
    """All rows plus ``admitted``."""
    return _mark(df, _notable(_rows(df, at, seq), settings), at, seq)


def seen_before(df: DataFrame, state: DataFrame, settings: Settings = DEFAULTS, at: str = "received_at") -> DataFrame:
    """Rows whose id has a stored admission that is still alive (or lies ahead) at arrival."""
    alive = _latest_admissions(state)
    due = F.col("admitted_at") + F.lit(settings.ttl_micros)
    return df.join(alive, (df["event_id"] == alive["event_id"]) & (micros(df[at]) < due), "left_semi")


def not_seen_before(df: DataFrame, state: DataFrame, settings: Settings = DEFAULTS, at: str = "received_at") -> DataFrame:
    alive = _latest_admissions(state)
    due = F.col("admitted_at") + F.lit(settings.ttl_micros)
    return df.join(alive, (df["event_id"] == alive["event_id"]) & (micros(df[at]) < due), "left_anti")


def _latest_admissions(state: DataFrame) -> DataFrame:
    return state.groupBy("event_id").agg(F.max(micros(F.col("admitted_at"))).alias("admitted_at"))


def mark_admitted_with_state(
    df: DataFrame,
    state: DataFrame,
    settings: Settings = DEFAULTS,
    at: str = "received_at",
    seq: str = "seq",
) -> DataFrame:
    """`mark_admitted` for one increment, given the stored ``(event_id, admitted_at)``.

    The stored admissions are looked up once, for the three narrow columns dedup works on.
    """
    due = F.col("admitted_at") + F.lit(settings.ttl_micros)
    rows = _rows(df, at, seq)
    # Only admissions of the increment's own ids are aggregated.
    stored = _latest_admissions(state.join(rows.select("event_id").distinct(), "event_id", "left_semi"))
    looked_up = cut_lineage(
        rows.join(stored, "event_id", "left")
        .select("event_id", "at", "seq", F.coalesce(F.col("at") < due, F.lit(False)).alias("known"))
    )
    repeats = looked_up.filter("known").select("event_id", "at", "seq", F.lit(True).alias("repeat")).distinct()
    fresh = looked_up.filter("NOT known").drop("known")
    return _mark(df, _notable(fresh, settings).unionByName(repeats), at, seq)


def next_state(state: DataFrame, marked: DataFrame, as_of: Column, settings: Settings = DEFAULTS, at: str = "received_at") -> DataFrame:
    """Stored admissions after an increment; windows that ended by ``as_of`` are dropped."""
    fresh = marked.filter("admitted").select("event_id", micros(F.col(at)).alias("admitted_at"))
    old = state.select("event_id", micros(F.col("admitted_at")).alias("admitted_at"))
    return (
        old.unionByName(fresh)
        .groupBy("event_id")
        .agg(F.max("admitted_at").alias("admitted_at"))
        .filter(F.col("admitted_at") + F.lit(settings.ttl_micros) > micros(as_of))
        .select("event_id", F.timestamp_micros("admitted_at").alias("admitted_at"))
    )
