"""Near-duplicate embeddings with a robust-pruned flat graph.

Vectors of one label (and length) are clustered into overlapping shards: k-means on a bounded
sample, each vector goes to its nearest centroid and to those whose border is nearer than ``margin``,
and shards that are still too large are split again. Each shard builds a graph: the nearest
neighbours of a vector and some distant ones, pruned robustly. The adjacency lists of a vector's
shards are united. Every vector then runs a greedy search from the shard's medoids (and from
itself), which widens over all nodes in range; cosines are exact, in double precision. A pair that
meets in several shards counts in the first of them. A bounded number of audit queries against all
rows measures recall; below ``recall`` the work is repeated with a wider margin.

A ball of vectors that no centroid can divide is counted exactly, block by block, so no shard has a
cap and no task holds more than two blocks.

Vectors that are null, empty or zero, hold null or non-finite components, or have no label link
with nothing and are their own component. Rows that repeat a vec_id are separate rows; a component
is named by its smallest vec_id, null ids last. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import map_batches, numbered
from weirgate.llm.components import components
from weirgate.llm.near_dedup import _id_of, _sortable
from weirgate.session import cut_lineage

RANGE = 0.98
#: Wanted and largest rows of a shard.
TARGET, LIMIT = 512, 4096
#: Sampled rows of a shard for its centroids, and most centroids of one split.
SAMPLE, SPLIT = 4096, 64
MARGIN = 0.14
#: Candidates of a node, edges kept, distant candidates, prune factor, beam width.
NEAR, DEGREE, FAR, ALPHA, BEAM = 48, 24, 8, 1.2, 32
#: Nodes this far out of range are expanded too, but are no links.
SLACK = 0.01
AUDIT = 256


def _matrix(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    column = table["vector"]
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def prepared(vectors: DataFrame) -> DataFrame:
    """``row``, ``node``, ``vec_id``, ``grp`` (null: links with nothing) and the unit ``vector``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for x, bad in zip(batch.column("vector").to_pylist(), batch.column("unlabelled").to_pylist()):
            v = None
            if x and not bad and None not in x:
                a = np.array(x, float)
                top = np.abs(a).max() if np.isfinite(a).all() else 0.0
                if top > 0:
                    a = a / top
                    v = a / np.sqrt(a @ a)
            out.append(v)
        return batch.set_column(batch.schema.get_field_index("vector"), "vector", _lists(out, pa.float64()))

    rows = numbered(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), "label")).select(
        "row", "vec_id", "vector", F.col("label").isNull().alias("unlabelled"), F.xxhash64("label", F.size("vector")).alias("grp")
    )
    done = map_batches(rows, work, "row long, vec_id long, vector array<double>, unlabelled boolean, grp long")
    return cut_lineage(done.select("row", F.concat(_sortable(F.col("vec_id")), _sortable(F.col("row"))).alias("node"), "vec_id", "vector", F.when(F.col("vector").isNotNull(), F.col("grp")).alias("grp")))


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(3)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def _centroids(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("row")
    k = int(min(SPLIT, -(-pdf["size"].iloc[0] // TARGET)))
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "centroids": [_kmeans(np.stack(pdf["vector"].to_numpy()), k).ravel()]})


def split(rows: DataFrame, margin: float) -> DataFrame:
    """Rows (``row``, ``vector``, ``shard``, ``size``) dealt to the shards around sampled centroids."""
    sampled = rows.filter(F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < F.lit(1_000_000.0 * SAMPLE) / F.col("size"))
    centroids = cut_lineage(sampled.groupBy("shard").applyInPandas(_centroids, "shard long, centroids array<double>"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, shards = _matrix_of(batch), np.asarray(batch.column("shard"))
        to = [None] * len(shards)
        for s in np.unique(shards):
            at = np.flatnonzero(shards == s)
            c = np.array(batch.column("centroids")[int(at[0])].as_py()).reshape(-1, len(x[at[0]]))
            v = np.stack([x[i] for i in at])
            apart = ((v[:, None, :] - c[None]) ** 2).sum(axis=2) if len(c) * len(v) * c.shape[1] < 5e7 else (c * c).sum(axis=1) - 2 * v @ c.T + 1
            home = apart.argmin(axis=1)
            between = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2))
            over = (apart - apart.min(axis=1)[:, None]) / np.maximum(2 * between[home], 1e-12)
            over[np.arange(len(v)), home] = 0
            for i, o in zip(at, over):
                to[i] = np.flatnonzero(o <= margin)
        kept = [batch.column(k) for k in ("row", "vector", "shard", "size")]
        return pa.RecordBatch.from_arrays([*kept, _lists(to, pa.int32())], ["row", "vector", "shard", "size", "to"])

    dealt = map_batches(rows.join(centroids, "shard").select("row", "vector", "shard", "size", "centroids"), work, "row long, vector array<double>, shard long, size long, to array<int>")
    return dealt.select("row", "vector", F.explode("to").alias("c"), "shard", F.col("size").alias("parent")).select(
        "row", "vector", F.xxhash64("shard", "c").alias("shard"), "parent"
    )


def _matrix_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    lists = batch.column("vector")
    values, ends = np.asarray(lists.values), np.asarray(lists.offsets)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def sized(rows: DataFrame) -> DataFrame:
    n = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("size"))
    return rows.join(n, "shard")


def shards(rows: DataFrame, margin: float) -> tuple[DataFrame, DataFrame]:
    """Rows in overlapping shards of at most ``LIMIT`` rows, and rows of balls that cannot be split."""
    state = cut_lineage(sized(rows.filter(F.col("grp").isNotNull()).select("row", "vector", F.col("grp").alias("shard"))))
    done, dense = state.filter(F.col("size") <= 2 * TARGET), state.limit(0)
    state = state.filter(F.col("size") > 2 * TARGET)
    while not state.isEmpty():
        rows_of = state.agg(F.countDistinct("row")).first()[0]
        after = cut_lineage(sized(split(state, margin)))
        if after.count() > 3 * rows_of:
            # Most vectors lie at many borders: these shards are balls that centroids do not divide.
            whole = state.select("row", "vector", "shard", "size")
            return done.unionByName(whole.filter(F.col("size") <= LIMIT)), dense.unionByName(whole.filter(F.col("size") > LIMIT))
        after, stuck = after.select("row", "vector", "shard", "size", "parent"), F.col("size") > 0.7 * F.col("parent")
        done = done.unionByName(after.filter(F.col("size") <= LIMIT).drop("parent"))
        dense = dense.unionByName(after.filter((F.col("size") > LIMIT) & stuck).drop("parent"))
        # What goes on has lost a third of its rows at least, so the rounds end.
        state = after.filter((F.col("size") > LIMIT) & ~stuck).drop("parent")
    return done, dense


def _pruned(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Edges of the nodes of a shard, -1 where there are fewer: robust pruning of near and distant candidates."""
    n = len(x)
    near = min(NEAR, n - 1)
    edges = np.full((n, DEGREE), -1, np.int64)
    if near < 1:
        return edges
    for a in range(0, n, 256):
        b = min(a + 256, n)
        sim = x[a:b] @ x.T
        sim[np.arange(b - a), np.arange(a, b)] = -2
        top = np.argpartition(-sim, near - 1, axis=1)[:, :near]
        cand = np.concatenate([top, rng.integers(0, n, (b - a, FAR))], axis=1)
        cand_sim = np.take_along_axis(sim, cand, axis=1)
        order = np.argsort(-cand_sim, axis=1, kind="stable")
        cand, cand_sim = np.take_along_axis(cand, order, axis=1), np.take_along_axis(cand_sim, order, axis=1)
        far = np.sqrt(np.maximum(2 - 2 * cand_sim, 0))
        v = x[cand]
        between = np.sqrt(np.maximum(2 - 2 * (v @ v.transpose(0, 2, 1)), 0))
        alive = cand != np.arange(a, b)[:, None]
        who = np.arange(b - a)
        for k in range(DEGREE):
            has = alive.any(axis=1)
            # The last edges are the most distant candidates that are left.
            pick = alive.argmax(axis=1) if k < DEGREE - 4 else alive.shape[1] - 1 - alive[:, ::-1].argmax(axis=1)
            edges[a:b, k] = np.where(has, cand[who, pick], -1)
            alive &= ~(ALPHA * between[who, pick] <= far) & (cand != cand[who, pick][:, None])
    return edges


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by("row")
    rows = table["row"].to_numpy()
    edges = _pruned(_matrix(table), np.random.default_rng(len(rows)))
    return pa.table({"row": table["row"], "edges": _lists([rows[e[e >= 0]] for e in edges], pa.int64())})


def _found(x: np.ndarray, edges: np.ndarray, least: float) -> np.ndarray:
    """Pairs in range, as a matrix: greedy search by all nodes from the medoids, then expansion in range."""
    n = len(x)
    mean = x.mean(axis=0)
    start = np.argsort(-(x @ mean), kind="stable")[:4]
    wide = least - SLACK
    hit = np.zeros((n, n), bool)
    for a in range(0, n, 256):
        q = np.arange(a, min(a + 256, n))
        m = len(q)
        seen, spread = np.zeros((m, n), bool), np.zeros((m, n), bool)
        beam = np.concatenate([np.broadcast_to(start, (m, len(start))), q[:, None]], axis=1)
        sim = np.einsum("md,mkd->mk", x[q], x[beam])
        sim[:, :-1][beam[:, :-1] == q[:, None]] = -3
        np.put_along_axis(seen, beam, True, axis=1)
        inside = np.zeros((m, n), bool)
        who = np.arange(m)
        while True:
            open_ = ~np.take_along_axis(spread, beam, axis=1) & (sim > -3)
            go = open_.any(axis=1)
            if not go.any():
                break
            best = np.where(open_, sim, -9).argmax(axis=1)
            node = beam[who, best]
            spread[who[go], node[go]] = True
            new = edges[node]
            fresh = (new >= 0) & go[:, None]
            fresh &= ~np.take_along_axis(seen, np.maximum(new, 0), axis=1)
            r, c = np.nonzero(fresh)
            got = np.full(new.shape, -3.0)
            got[r, c] = np.einsum("id,id->i", x[q[r]], x[new[r, c]])
            seen[r, new[r, c]] = True
            near = got >= wide
            rr, cc = np.nonzero(near)
            inside[rr, new[rr, cc]] = True
            beam, sim = np.concatenate([beam, np.maximum(new, 0)], axis=1), np.concatenate([sim, got], axis=1)
            if beam.shape[1] > BEAM:
                top = np.argpartition(-sim, BEAM - 1, axis=1)[:, :BEAM]
                beam, sim = np.take_along_axis(beam, top, axis=1), np.take_along_axis(sim, top, axis=1)
        near = np.einsum("md,kd->mk", x[q], x[start]) >= wide
        rr, cc = np.nonzero(near)
        inside[rr, start[cc]] = True
        # Every node in range is expanded until no new one is in range.
        while True:
            r, node = np.nonzero(inside & ~spread)
            if not len(r):
                break
            spread[r, node] = True
            new = edges[node]
            ok = new >= 0
            r, new = np.repeat(r, ok.sum(axis=1)), new[ok]
            ask = np.unique(r[~seen[r, new]] * n + new[~seen[r, new]])
            r, new = ask // n, ask % n
            seen[r, new] = True
            good = np.einsum("id,id->i", x[q[r]], x[new]) >= wide
            inside[r[good], new[good]] = True
        inside[who, q] = False
        r, c = np.nonzero(inside)
        good = np.einsum("id,id->i", x[q[r]], x[c]) >= least
        hit[q[r[good]], c[good]] = True
    return hit | hit.T


def _roots(hit: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component."""
    at = np.arange(len(hit))
    r, c = np.nonzero(hit)
    while True:
        new = at.copy()
        np.minimum.at(new, r, at[c])
        new = new[new]
        if (new == at).all():
            return at
        at = new


def _first_met(table: pa.Table, here: int) -> np.ndarray:
    """Pairs that meet in no earlier shard; the others count there."""
    lists = table["shards"].to_pylist()
    index = {s: i for i, s in enumerate(sorted({s for x in lists for s in x if s < here}))}
    member = np.zeros((len(lists), max(1, len(index))), np.float32)
    for i, x in enumerate(lists):
        member[i, [index[s] for s in x if s < here]] = 1
    return (member @ member.T) == 0


def _search(least: float):
    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        here, rows = key[0].as_py(), table["row"].to_numpy()
        order = np.argsort(rows)
        lists = [np.asarray(e) if e is not None else np.zeros(0, np.int64) for e in table["edges"].to_pylist()]
        edges = np.full((len(rows), max(1, max(map(len, lists)))), -1, np.int64)
        for i, e in enumerate(lists):
            at = np.minimum(np.searchsorted(rows[order], e), len(rows) - 1)
            e = order[at][rows[order][at] == e]
            edges[i, : len(e)] = e
        hit = _found(_matrix(table), edges, least)
        root = _roots(hit)
        counted = hit & _first_met(table, here)
        node = table["node"].combine_chunks()
        return pa.table({"node": node, "links": pa.array(counted.sum(axis=1).astype(np.int64)), "root": node.take(pa.array(root))})

    return work


def _block(least: float):
    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        x, own = _matrix(table), table["block"].to_numpy()
        low, high = key[1].as_py(), key[2].as_py()
        hit = x @ x.T >= least
        np.fill_diagonal(hit, False)
        # A pair within one block counts in that block's own task.
        counted = hit & _first_met(table, key[0].as_py())
        if low != high:
            counted &= own[:, None] != own[None, :]
        node = table["node"].combine_chunks()
        return pa.table({"node": node, "links": pa.array(counted.sum(axis=1).astype(np.int64)), "root": node.take(pa.array(_roots(hit)))})

    return work


_RESULT = "node binary, links long, root binary"


def _linked(rows: DataFrame, least: float, margin: float) -> DataFrame:
    """``node``, ``links`` and ``root`` by shard."""
    done, dense = shards(rows, margin)
    done, dense = cut_lineage(done.select("row", "shard")), cut_lineage(dense.select("row", "shard", "size"))
    vectors = rows.filter(F.col("grp").isNotNull()).select("row", "node", "vector")
    placed = done.join(vectors, "row")
    members = done.union(dense.select("row", "shard")).groupBy("row").agg(F.collect_set("shard").alias("shards"))
    graph = placed.select("row", "vector", "shard").groupBy("shard").applyInArrow(_build, "row long, edges array<long>")
    # A vector's edges in all its shards are united; DEGREE times its shards bounds the list.
    index = cut_lineage(
        graph.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges")).join(members, "row")
    )
    found = placed.join(index, "row").groupBy("shard").applyInArrow(_search(least), _RESULT)
    if dense.isEmpty():
        return found
    whole = dense.join(vectors, "row").join(members, "row").withColumn("n", F.ceil(F.col("size") / TARGET))
    blocks = whole.withColumn("block", F.pmod(F.xxhash64("row"), F.col("n")))
    dealt = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    tasks = dealt.select(
        "node", "vector", "shards", "block", "shard", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    return found.union(tasks.groupBy("shard", "low", "high").applyInArrow(_block(least), _RESULT))


def _recall(rows: DataFrame, found: DataFrame, least: float, queries: int) -> float:
    """Share of the links of some queries, counted against all rows, that were found."""
    valid = rows.filter(F.col("grp").isNotNull())
    total = valid.count()
    some = valid.filter(F.pmod(F.xxhash64("row", F.lit(5)), F.lit(1_000_000)) < F.lit(1_000_000.0 * queries / max(total, 1))).select("node", "grp", "vector").collect()
    if not some:
        return 1.0
    by: dict[int, tuple[list, np.ndarray]] = {}
    for g in {(r["grp"], len(r["vector"])) for r in some}:
        mine = [r for r in some if (r["grp"], len(r["vector"])) == g]
        by[g[0]] = [bytes(r["node"]) for r in mine], np.array([r["vector"] for r in mine])
    shared = rows.sparkSession.sparkContext.broadcast(by)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grp, x = np.asarray(batch.column("grp")), _matrix_of(batch)
        nodes, n = [], []
        for g, (own, q) in shared.value.items():
            at = np.flatnonzero(grp == g)
            if len(at):
                nodes += own
                n += (np.stack([x[i] for i in at]) @ q.T >= least).sum(axis=0).tolist()
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(n, pa.int64())], ["node", "n"])

    # A query is in range of itself.
    true = map_batches(valid.select("grp", "vector"), work, "node binary, n long").groupBy("node").agg((F.sum("n") - 1).alias("n"))
    got = true.join(found, "node", "left").agg(F.sum("n"), F.sum(F.least("n", F.coalesce("links", F.lit(0))))).first()
    return got[1] / got[0] if got[0] else 1.0


def vector_classes(vectors: DataFrame, least: float = RANGE, margin: float = MARGIN, recall: float = 0.99, audit: int = AUDIT) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    rows = prepared(vectors)
    while True:
        parts = cut_lineage(_linked(rows, least, margin))
        links = cut_lineage(parts.groupBy("node").agg(F.sum("links").alias("links")))
        if margin >= 1 or _recall(rows, links, least, audit) >= recall:
            break
        margin *= 2
    edges = parts.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    label = F.coalesce("label", "node")
    out = rows.select("node", "vec_id").join(links, "node", "left").join(components(edges), "node", "left")
    component = _id_of(label).alias("component_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
