"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A document is the multiset of its runs of five words (words end at ASCII white space, case counts);
one of fewer words is a single shingle. BagMinHash gives each shingle independent Poisson
processes over the dyadic intervals [0, 1), [1, 2), [2, 4) ... of its weight: a shingle that occurs w
times takes the points below w, so a weight costs its logarithm. Each signature component is the
first point that falls on it, and two documents agree in a component with the probability of their
weighted Jaccard similarity. Bands of components give candidates, and the exact overlap of the
multisets decides: linked from 0.8 on.

Equal texts are one node. Candidates are never all pairs of a bucket: nodes are compared with the
smallest node of their buckets, then with more pivots, and only what is still in different
components goes on. Shingles that no other open node has bound a node's overlap with any other, so
a copy with many edits of its own is settled without a partner. Pairs across components are then
compared to the last; in large buckets rare shingles list those that share one, and the others are
bounded by their frequent shingles. No bucket has a cap, and a group of n copies costs about n
comparisons.

Texts without words, null and empty ones included, link with nothing and are classes of their own,
also when they are equal. Rows that repeat an id and a text are copies; one row is kept. Null ids
come last, so a class has a null id only if all its documents do. An empty table gives no rows.
``drop_near_copies`` keeps all columns of the documents whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import map_batches, numbered, raw_texts
from weirgate.llm.components import components
from weirgate.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
#: Buckets of more nodes than this list pairs by rare and frequent shingles apart.
LARGE = 64
#: Elements of fewer nodes than this list their pairs in large buckets.
RARE = 128
PIVOTS = 4
#: Bytes of text whose signatures are made together.
_STRETCH = 1 << 20
_U = np.uint64
_TABLE = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
#: Powers that are kept; longer texts have theirs made for the call.
_KEPT_POWERS = 1 << 20
#: Bytes of text whose shingles a batch of pairs keeps at hand.
_BAG_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse modulo 2^64."""
    return _kept_powers() if n <= _KEPT_POWERS else _made_powers(n)


@lru_cache(maxsize=1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _made_powers(_KEPT_POWERS)


def _made_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(_BASE, -1, 1 << 64))
    up, down = np.full(n, _U(_BASE)), np.full(n, inverse)
    up[0] = down[0] = _U(1)
    return np.cumprod(up), np.cumprod(down)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word, from prefix sums of byte values times powers."""
    up, down = _powers(len(data) + 1)
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[: len(data)])])
    return starts, mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``size`` words; fewer words are one run."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = mixed(out + words[k : len(words) - size + 1 + k] + _U(k))
    return out


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """BagMinHash of (shingle hashes, weights) of each document; documents must not be empty."""
    doc = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])
    key = np.concatenate([h for h, _ in bags])
    weight = np.concatenate([w for _, w in bags])
    # One process for each dyadic interval that a weight reaches; its rate is the interval's length.
    parts = [(doc, mixed(key), np.ones(len(key), np.int64), weight)]
    low = 1
    while (more := weight > low).any():
        doc, key, weight = doc[more], key[more], weight[more]
        parts.append((doc, mixed(key + _U(low * _BASE % (1 << 64))), np.full(len(key), low), weight))
        low *= 2
    doc, key, length, weight = (np.concatenate(x) for x in zip(*parts))
    partial = np.zeros(len(doc), bool)
    partial[len(parts[0][0]) :] = True
    time, out = np.zeros(len(doc)), np.full((len(bags), size), np.inf)
    flat = out.reshape(-1)
    number = 0
    while len(doc):
        number += 1
        draw = mixed(key + _U(number * _BASE % (1 << 64)))
        time = time - np.log(((draw >> _U(11)).astype(np.float64) + 1) * 2.0**-53) / (length * size)
        live = time < out.max(axis=1)[doc]
        doc, key, length, weight, partial, time, draw = (x[live] for x in (doc, key, length, weight, partial, time, draw))
        place = mixed(draw)
        counts = ~partial
        if partial.any():
            # Points of an interval [l, 2l) count only below the weight.
            at = length + (mixed(place) % length.astype(np.uint64)).astype(np.int64)
            counts |= at < weight
        cell = doc * size + ((place >> _U(33)) % _U(size)).astype(np.int64)
        np.minimum.at(flat, cell[counts], time[counts])
    return out


def band_hashes(texts: list[bytes], bands: int = BANDS, rows: int = ROWS) -> list[np.ndarray | None]:
    """Hashes of the bands of each text; None without words."""
    out: list[np.ndarray | None] = [None] * len(texts)
    i = 0
    while i < len(texts):
        j, total = i, 0
        while j < len(texts) and (j == i or total + len(texts[j]) <= _STRETCH):
            total += len(texts[j]) + 1
            j += 1
        some = texts[i:j]
        data = np.frombuffer(b" ".join(some) + b" ", np.uint8)
        starts, words = word_hashes(data)
        edges = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in some]))
        bags, at = [], []
        for k in range(len(some)):
            if edges[k + 1] > edges[k]:
                bags.append(np.unique(shingle_hashes(words[edges[k] : edges[k + 1]]), return_counts=True))
                at.append(i + k)
        if bags:
            bits = signatures(bags, bands * rows).view(np.uint64).reshape(len(bags), bands, rows)
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
            for r in range(rows):
                key = mixed(key + bits[:, :, r])
            for k, row in zip(at, key):
                out[k] = row.view(np.int64)
        i = j
    return out


def _sortable(c: Column) -> Column:
    """A long as eight bytes in its order; null after all."""
    return F.unhex(F.coalesce(F.lpad(F.hex(c.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lit("F" * 16)))


def _id_of(node: Column) -> Column:
    head = F.hex(F.substring(node, 1, 8))
    flipped = F.concat(F.hex((F.conv(F.substring(head, 1, 1), 16, 10).cast("int")).bitwiseXOR(F.lit(8))), F.substring(head, 2, 15))
    return F.when(head != "F" * 16, F.conv(flipped, 16, -10).cast("long"))


def overlap(a: bytes, b: bytes, size: int = SHINGLE) -> float:
    """Weighted Jaccard similarity of the shingle multisets."""
    return _alike(bag(a, size), bag(b, size))


def _alike(x: Counter, y: Counter) -> float:
    n, m = x.total(), y.total()
    if not n or not m:
        return 0.0
    if len(y) < len(x):
        x, y = y, x
    both = sum(min(c, y[s]) for s, c in x.items() if s in y)
    return both / (n + m - both)


def remembered(build: Callable[[bytes], Counter], most: int = _BAG_BYTES) -> Callable[[bytes], Counter]:
    """``build`` that keeps what it made of the last texts, ``most`` bytes of text at most."""
    kept: dict[bytes, Counter] = {}
    total = 0

    def get(text: bytes) -> Counter:
        nonlocal total
        if text not in kept:
            if total + len(text) > most:
                kept.clear()
                total = 0
            if len(text) > most:
                return build(text)
            kept[text] = build(text)
            total += len(text)
        return kept[text]

    return get


def bag(text: bytes, size: int = SHINGLE) -> Counter:
    words = text.split()
    if len(words) < size:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*[words[k:] for k in range(size)]))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least ``similarity`` alike."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        # Pairs of one node lie together more often than not; what is kept goes with the batch.
        of = remembered(bag)
        x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
        keep = [_alike(of(a), of(b)) >= similarity for a, b in zip(x, y)]
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b"
    )
    return cut_lineage(map_batches(both.select("a", "b", "x", "y"), work, "a binary, b binary"))


def _elements(nodes: DataFrame, texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``id`` (hash of the node) and ``element``: the shingles of the nodes, repeated ones numbered."""

    def work(batch: pa.RecordBatch):
        for node, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            found = np.sort(shingle_hashes(word_hashes(np.frombuffer(text + b" ", np.uint8))[1], size))
            # The second and later ones of a shingle are elements of their own.
            fresh = np.concatenate([[True], found[1:] != found[:-1]])
            at = np.arange(len(found))
            rank = at - np.maximum.accumulate(np.where(fresh, at, 0))
            elements = mixed(found + rank.astype(np.uint64) * _U(_BASE)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), node)), pa.array(elements)], ["id", "element"])

    rows = texts.join(nodes, "node", "left_semi").select(F.xxhash64("node").alias("id"), "text")
    return cut_lineage(map_batches(rows, work, "id long, element long"))


def _supported(elements: DataFrame) -> DataFrame:
    """``id``, ``n`` (elements) and ``s`` (those that another of the nodes has too).

    No overlap with another node is larger than ``s``, which settles copies with many edits of
    their own.
    """
    alone = elements.groupBy("element").agg(F.count(F.lit(1)).alias("times"), F.min("id").alias("id")).filter("times = 1")
    lonely = alone.groupBy("id").agg(F.count(F.lit(1)).alias("alone"))
    total = elements.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return total.join(lonely, "id", "left").select("id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s"))


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the buckets that still hold more than one component, with ``label`` and the bucket's ``size``."""
    kept = [c for c in members.columns if c not in ("label", "size")]
    rows = members.select(*kept).join(components(links), "node", "left").select(*kept, F.coalesce("label", "node").alias("label"))
    return cut_lineage(_open(rows))


def _open(rows: DataFrame) -> DataFrame:
    buckets = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    return rows.join(buckets.filter("low <> high").select("bucket", "size"), "bucket")


def _possible(x: str, y: str, similarity: float) -> Column:
    """Whether the supported shingles of two nodes allow the similarity."""
    most = F.least(F.col(f"s{x}"), F.col(f"s{y}"))
    return most >= F.lit(similarity) * (F.col(f"n{x}") + F.col(f"n{y}") - most)


def _side(rows: DataFrame, x: str) -> DataFrame:
    return rows.select("bucket", F.col("node").alias(x), F.col("label").alias(f"l{x}"), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}"))


def _pairs(few: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs of a bucket's nodes in different components, one of them from ``few``."""
    both = _side(few, "x").join(_side(rows, "y"), "bucket").filter((F.col("lx") != F.col("ly")) & _possible("x", "y", similarity))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _across(rows: DataFrame, similarity: float) -> DataFrame:
    """All pairs across components in the buckets: what is outside the largest component against all."""
    sizes = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("many"))
    main = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("many", "label")).alias("main"))
    return _pairs(rows.join(main, "bucket").filter("label <> main"), rows, similarity)


def _across_large(rows: DataFrame, elements: DataFrame, similarity: float) -> DataFrame:
    """The same for large buckets, by way of rare elements: those that fewer than ``RARE`` open nodes have.

    Two nodes share a rare element, and then it lists them, few at a time; or they share none, and
    then their frequent elements alone have to allow the similarity.
    """
    nodes = rows.select("node", "label", "n", "s", F.xxhash64("node").alias("id")).distinct()
    seldom = elements.groupBy("element").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") < RARE)
    rare = cut_lineage(elements.join(seldom, "element"))
    listed = rare.filter("times > 1").join(nodes, "id").withColumnRenamed("element", "bucket")
    sharing = _pairs(listed, listed, similarity)
    few = rare.groupBy("id").agg(F.count(F.lit(1)).alias("few"))
    frequent = nodes.join(few, "id", "left").select("node", (F.col("n") - F.coalesce("few", F.lit(0))).alias("s"))
    rest = rows.drop("s", "size").join(frequent, "node").filter(F.col("s") >= F.lit(similarity) * F.col("n"))
    return sharing.union(_across(rest, similarity))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``key`` (md5 of the text), ``class_id`` (smallest id of the class) and ``kept``."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = band_hashes(raw_texts(batch.column("text")), bands, rows)
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("key"), pa.array(found, pa.list_(pa.int64()))],
            ["row", "doc_id", "key", "bands"],
        )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("key"))
    signed = cut_lineage(map_batches(numbered(source), sign, "row long, doc_id long, key binary, bands array<long>"))
    own = F.concat(_sortable(F.col("doc_id")), _sortable(F.col("row")))
    worded = signed.filter(F.col("bands").isNotNull())
    nodes = cut_lineage(worded.groupBy("key").agg(F.min(own).alias("node"), F.any_value("bands").alias("bands")))

    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot")).filter("size > 1")
    members = cut_lineage(buckets.join(shared, "bucket"))
    chosen = nodes.join(members.select("node").distinct(), "node", "left_semi").select("key", "node")
    texts = cut_lineage(
        source.select("key", F.col("text").cast("binary").alias("text"))
        .join(chosen, "key")
        .groupBy("node")
        .agg(F.any_value("text").alias("text"))
    )

    # First the smallest node that each node meets in any bucket.
    pairs = members.filter("pivot < node").groupBy("node").agg(F.min("pivot").alias("a")).select("a", F.col("node").alias("b"))
    links = verified(pairs, texts, similarity)
    members = members.select("bucket", "node")
    # Nodes whose own shingles rule out every partner are done.
    open_ = _labelled(members, links)
    elements = _elements(open_.select("node").distinct(), texts)
    support = _supported(elements).filter(F.col("s") >= F.lit(similarity) * F.col("n"))
    hashed = open_.drop("size").withColumn("id", F.xxhash64("node"))
    open_ = cut_lineage(_open(hashed.join(support, "id").drop("id")))
    # Then some pivots of the buckets that are not one component yet.
    order = [F.min_by("node", F.xxhash64("node", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)]
    pivots = open_.groupBy("bucket").agg(*order).select("bucket", F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(PIVOTS)]))).alias("node"))
    links = links.union(verified(_pairs(open_.join(pivots, ["bucket", "node"]), open_, similarity), texts, similarity))
    # Then every pair across the components that are left in a bucket.
    open_ = _labelled(open_, links)
    small, large = open_.filter(F.col("size") <= LARGE), open_.filter(F.col("size") > LARGE)
    rest = _across(small, similarity).union(_across_large(large, elements, similarity)).distinct()
    links = links.union(verified(rest, texts, similarity))

    found = nodes.join(components(links), "node", "left").select("key", F.coalesce("label", "node").alias("label"))
    out = signed.join(found, "key", "left").withColumn("label", F.when(F.col("bands").isNull(), own).otherwise(F.col("label")))
    return out.select("doc_id", "key", _id_of(F.col("label")).alias("class_id"), (F.col("label") == own).alias("kept"))


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns."""
    kept = near_classes(docs, similarity).filter("kept").select("doc_id", "key")
    key = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    names = [f"`{c}`" for c in docs.columns]
    packed = docs.select(F.struct(*names).alias("doc"), F.col("doc_id").cast("long").alias("id"), key.alias("key"))
    kept = kept.withColumnRenamed("doc_id", "id").select(F.coalesce("id", F.lit(0)).alias("id_or"), F.col("id").isNull().alias("none"), "key", F.lit(1).alias("one"))
    packed = packed.select("doc", F.coalesce("id", F.lit(0)).alias("id_or"), F.col("id").isNull().alias("none"), "key")
    return packed.join(kept.distinct(), ["id_or", "none", "key"], "left_semi").dropDuplicates(["id_or", "none", "key"]).select("doc.*")
