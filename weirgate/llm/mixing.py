"""Mixing sources to target weights with the cube method.

Sizes are words. The sources, by code point with null last, weigh ``weights`` in turn and share
``share`` times all sizes; no target goes beyond ``limit`` times its source's size, what is over is
shared again by weight. A document is taken whole, as often as the whole part of
target / source size says, and once more with the fractional part as its probability. These
probabilities are settled by the cube method: within a block of a source, three documents at a
time move along the null space of their balance equations (number of documents, number of words)
until one is in or out. A block leaves at most two open documents; those of many blocks meet in the
next round; in a source's last block a dozen documents at most are landed, where the settlement
nearest to the source's balance wins. Blocks are bounded in rows and bytes, so a
source with a third of all rows is many tasks; equal rows that are more than a block are numbered,
and spread by their number.

Draws come from a generator seeded by the block and rows are ordered by their content, so reruns
agree. A null text has size 0. Documents of size 0 count in the balance of documents. Rows of the
same content are interchangeable and each settled on its own. An empty table gives no rows. Columns
of the input that clash with those added are replaced by them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import WORD
from weirgate.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
BLOCK_ROWS = 1024
BLOCK_BYTES = 16 << 20
#: Documents of a source that wait for the landing.
LANDING = 10
_TINY = 1e-9


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``source``, ``sid``, ``rows``, ``bytes``, ``source_size`` and ``target`` from rows with ``source``, ``size``, ``bytes``.

    The windows run over one row per source. Sources ordered by limit / weight reach their limit
    one after the other; the rest share what is left by weight.
    """
    totals = sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"), F.sum("size").alias("source_size")
    )
    turn = (F.col("sid") - 1) % len(weights)
    ranked = totals.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    )
    everything = Window.partitionBy(F.lit(0))
    by_ratio = everything.orderBy(F.col("source_size") / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(everything) - limit * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level).withColumn("full", level * F.col("weight") >= limit * F.col("source_size"))
    final = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.col("source_size") / F.col("weight"))).over(everything)
    return levels.withColumn("final", final).select(
        "source", "sid", "rows", "bytes", "source_size",
        F.when(F.col("full"), limit * F.col("source_size")).otherwise(F.col("final") * F.col("weight")).alias("target"),
    )


def fly(p: np.ndarray, size: np.ndarray, seed: int, land: bool) -> np.ndarray:
    """Moves probabilities to 0 or 1 and keeps the sums of ``p`` and ``p * size``; two at most stay open.

    With ``land`` all are settled: ``LANDING`` documents spread over the sizes wait until the flight
    is over, and of all ways to settle them and the last two, one nearest to the sums is taken.
    """
    rng = np.random.default_rng(seed)
    want, want_n = float(p @ size), float(p.sum())
    p = np.where(p <= _TINY, 0.0, np.where(p >= 1 - _TINY, 1.0, p)).tolist()
    s = size.astype(float).tolist()
    waiting = [i for i in range(len(p)) if 0 < p[i] < 1][::-1]
    kept = []
    if land:
        kept = [waiting[i] for i in np.unique(np.linspace(0, len(waiting) - 1, LANDING).round().astype(int))] if waiting else []
        apart = set(kept)
        waiting = [i for i in waiting if i not in apart]
    live = [waiting.pop() for _ in range(min(3, len(waiting)))]
    draws = iter(())
    while len(live) == 3:
        a, b, c = (s[i] for i in live)
        u = (b - c, c - a, a - b)
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min(((1 - p[i]) / d if d > 0 else -p[i] / d) for i, d in zip(live, u) if d)
        down = min((p[i] / d if d > 0 else (p[i] - 1) / d) for i, d in zip(live, u) if d)
        draw = next(draws, None)
        if draw is None:
            draws = iter(rng.random(256).tolist())
            draw = next(draws)
        step = up if draw * (up + down) < down else -down
        for i, d in zip(live, u):
            p[i] += step * d
            p[i] = 0.0 if p[i] < _TINY else 1.0 if p[i] > 1 - _TINY else p[i]
        live = [i for i in live if 0 < p[i] < 1]
        while waiting and len(live) < 3:
            live.append(waiting.pop())
    out = np.array(p)
    if land and (kept or live):
        open_ = np.array(live + kept)
        out[open_] = 0.0
        ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
        off = np.abs(ways @ size[open_] + float(out @ size) - want)
        off_n = np.abs(ways.sum(axis=1) + float(out.sum()) - want_n)
        # Words first, then documents; equal ways are drawn.
        out[open_] = ways[np.lexsort((rng.random(len(ways)), off_n, off))[0]]
    return out


def _told_apart(rows: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """``again``, a row's place among those of its ``tie``, where these are more than a block holds; else 0.

    Rows are counted in slices first, so no task numbers all rows of a tie.
    """
    times = rows.groupBy("tie").agg(F.count(F.lit(1)).alias("times"), F.sum("bytes").alias("held"))
    heavy = cut_lineage(times.filter((F.col("times") > block_rows) | ((F.col("times") > 1) & (F.col("held") > block_bytes))).select("tie"))
    if heavy.isEmpty():
        return rows.withColumn("again", F.lit(0).cast("long"))
    many = rows.join(heavy, "tie", "left_semi").withColumn("at", F.monotonically_increasing_id())
    many = cut_lineage(many.withColumn("slice", F.floor(F.col("at") / block_rows).cast("long")))
    counts = many.groupBy("tie", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tie").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("tie", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("tie", "slice").orderBy("at")) - 1
    many = many.withColumn("again", place.cast("long")).join(counts, ["tie", "slice"]).withColumn("again", F.col("again") + F.col("before"))
    few = rows.join(heavy, "tie", "left_anti").withColumn("again", F.lit(0).cast("long"))
    return few.unionByName(many.select(*few.columns))


def _mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc`` (all columns of a document), ``size``, ``source_size``, ``target`` and ``copies``."""
    text = F.col("text").cast("string") if "text" in docs.columns else None
    given = "size" in docs.columns and text is None
    # The document travels as one column, so its names meet no others.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("source").cast("string").alias("source"),
        (F.col("size") if given else F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))).cast("long").alias("size"),
        (F.coalesce(F.octet_length(text), F.lit(0)) if text is not None else F.lit(0)).cast("long").alias("bytes"),
        F.xxhash64(*[F.col(f"`{c}`") for c in ("doc_id", "text", "text_hash", "source") if c in docs.columns]).alias("tie"),
    )
    targets = cut_lineage(source_targets(rows.select("source", "size", "bytes"), weights, share, limit))
    rows = _told_apart(rows, block_rows, block_bytes)
    most = targets.agg(F.max(F.greatest(F.ceil(F.col("rows") / block_rows), F.ceil(F.col("bytes") / block_bytes)))).first()[0] or 1
    pi = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    state = (
        rows.join(targets.withColumnRenamed("source", "src").withColumnRenamed("rows", "n").withColumnRenamed("bytes", "n_bytes"), rows["source"].eqNullSafe(F.col("src")))
        .withColumn("pi", pi)
        .withColumn("whole", F.floor(F.col("pi") + _TINY))
        .select(
            "doc", "sid", "size", "source_size", "target", "tie", "again", "whole",
            F.greatest(F.col("pi") - F.col("whole"), F.lit(0.0)).alias("p"),
            F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("n_bytes") / block_bytes), F.lit(1)).cast("long").alias("blocks"),
        )
    )
    settled, level = [], 0
    while True:
        last = most <= 1
        state = state.withColumn("block", F.pmod(F.xxhash64("tie", "again", F.lit(level)), F.col("blocks")))
        done = cut_lineage(state.groupBy("sid", "block").applyInArrow(_block_work(level, last), state.schema))
        if last:
            settled.append(done)
            break
        settled.append(done.filter("p = 0 OR p = 1"))
        # Two of each block at most stay open.
        most = -(-2 * most // block_rows)
        state = done.filter("p > 0 AND p < 1").withColumn("blocks", F.ceil(2 * F.col("blocks") / block_rows).cast("long"))
        level += 1
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    return out.select("doc", "size", "source_size", "target", (F.col("whole") + F.round("p")).cast("long").alias("copies"))


def _block_work(level: int, last: bool):
    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        size, tie, again = (table[k].to_numpy() for k in ("size", "tie", "again"))
        # Large documents first: what is left at the end is small.
        order = np.lexsort((again, tie, -size))
        table = table.take(pa.array(order))
        blocks = table["blocks"][0].as_py()
        seed = zlib.crc32(f"{level}/{key[0].as_py()}/{key[1].as_py()}".encode())
        p = fly(table["p"].to_numpy(), size[order], seed, land=last or blocks <= 1)
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p))

    return work


def mix(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``."""
    added = ("size", "source_size", "target", "copies")
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c not in added]
    return _mixed(docs, **options).select(*kept, *added)


def take(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, with all their columns, once for each copy."""
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    rows = _mixed(docs, **options).filter("copies > 0").select("doc", F.explode(copies).alias("copy"))
    return rows.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
