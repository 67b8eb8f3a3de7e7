"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are runs of ASCII digits, ASCII letters lower-cased and all characters beyond ASCII. The
patterns are the windows of ``size`` consecutive words of each item; an item with fewer words is
one window. A shift table says for each pair of neighbouring words how far the search may jump, so
most positions of a clean text are never looked at; a pair with shift 0 selects a bucket of
windows, and comparing all words confirms an occurrence.

Windows are cut and their tables built in tasks, in blocks of about ``block_windows`` by a hash of the
window. Each block is broadcast and is one pass over all documents, so what tasks and the driver hold
stays bounded. Documents never move.

Null texts have no words. Items without words, null ones included, occur nowhere. Items with a null
id count as one item with the empty name. Repeated documents each get their row. Empty tables are
allowed on both sides. ``decontaminate`` keeps all columns of the documents, whatever their names;
``occurrences`` returns ``doc_id`` and its results only.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import map_batches, raw_texts
from weirgate.session import cut_lineage

WINDOW = 10
#: Windows that are searched for together.
BLOCK_WINDOWS = 100_000
#: A-Z to a-z; every other ASCII sign but digits and a-z to a space; bytes beyond ASCII as they are.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> set[tuple[bytes, ...]]:
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


class Tables:
    """Shift table and buckets of patterns that all have at least ``least`` words."""

    def __init__(self, patterns: list[tuple[bytes, ...]]) -> None:
        self.least = least = min(map(len, patterns))
        self.block = block = min(2, least)
        self.jump = least - block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = defaultdict(list)
        for p in patterns:
            for end in range(block, least + 1):
                key = p[end - block : end]
                self.shift[key] = min(self.shift.get(key, self.jump), least - end)
            self.buckets[p[least - block : least]].append(p)

    def search(self, words: list[bytes]):
        """(start, pattern) of every occurrence."""
        shift, buckets, jump, least, block, n = self.shift.get, self.buckets, self.jump, self.least, self.block, len(words)
        end = least
        while end <= n:
            key = tuple(words[end - block : end])
            by = shift(key, jump)
            if by:
                end += by
                continue
            start = end - least
            for p in buckets[key]:
                if tuple(words[start : start + len(p)]) == p:
                    yield start, p
            end += 1


class Matcher:
    """A block of windows and their items; full windows and shorter items have tables of their own."""

    def __init__(self, items: dict[tuple[bytes, ...], list[str]], size: int = WINDOW) -> None:
        self.items = items
        full = [w for w in items if len(w) == size]
        short = [w for w in items if len(w) < size]
        self.tables = [Tables(x) for x in (full, short) if x]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words that an occurrence covers, and the items that occur."""
        spans, names = [], set()
        for t in self.tables:
            for start, p in t.search(words):
                spans.append((start, start + len(p)))
                names.update(self.items[p])
        return spans, names


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``words`` (one space between) and ``names`` of the items of every distinct window."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).filter(F.col("text").isNotNull())

    def work(batch: pa.RecordBatch):
        for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
            found = [b" ".join(w) for w in windows_of(words_of(text), size)]
            for i in range(0, len(found), 10_000):
                some = found[i : i + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some, pa.binary())], ["name", "words"])

    return map_batches(items, work, "name string, words binary").groupBy("words").agg(F.collect_set("name").alias("names"))


def matchers(benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> list:
    """Broadcast matchers, one for each block of the benchmark's windows.

    Windows are cut, told apart and put into tables in tasks; the driver passes on one block at a time.
    """
    windows = cut_lineage(item_windows(benchmark, size))
    blocks = -(-windows.count() // block_windows)
    if not blocks:
        return []

    def build(table: pa.Table) -> pa.Table:
        items = {tuple(w.split()): names for w, names in zip(table.column("words").to_pylist(), table.column("names").to_pylist())}
        return pa.table({"matcher": pa.array([pickle.dumps(Matcher(items, size))], pa.binary())})

    dealt = windows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    built = cut_lineage(dealt.groupBy("block").applyInArrow(build, "matcher binary"))
    sc = benchmark.sparkSession.sparkContext
    return [sc.broadcast(pickle.loads(bytes(r["matcher"]))) for r in built.toLocalIterator()]


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` (pairs of start and end in words) and ``items`` of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    state = docs.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    blocks = matchers(benchmark, size, block_windows)
    for i, shared in enumerate(blocks or [None]):
        last = i + 1 >= len(blocks)

        def work(batch: pa.RecordBatch, shared=shared, last=last) -> pa.RecordBatch:
            n_words, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            for text, (old_spans, old_items) in zip(raw_texts(batch.column("text")), before):
                words = words_of(text)
                found, names = shared.value.find(words) if shared is not None else ([], set())
                n_words.append(len(words))
                spans.append(old_spans + [x for s in found for x in s])
                items.append(sorted({*old_items, *names}))
            text = pa.nulls(len(n_words), pa.string()) if last else batch.column("text")
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), text, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "spans", "items"],
            )

        state = map_batches(state, work, f"doc_id {kind}, text string, n_words long, spans array<int>, items array<string>")
    return state.select("doc_id", "n_words", "spans", "items")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit, names = [], []
        for n, spans, items in zip(batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
            marks = np.zeros(n, bool)
            for a, b in zip(spans[::2], spans[1::2]):
                marks[a:b] = True
            hit.append(int(marks.sum()))
            names.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
        size = pa.array([len(x) for x in batch.column("items").to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(hit, pa.int64()), size, pa.array(names), pa.array([h > 0 for h in hit])],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    kind = found.schema["doc_id"].dataType.simpleString()
    return map_batches(found, work, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    at = docs.columns.index("text")
    for shared in matchers(benchmark, size, block_windows):

        def work(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            clean = [not shared.value.find(words_of(t))[0] for t in raw_texts(batch.column(at))]
            return batch.filter(pa.array(clean, pa.bool_()))

        docs = map_batches(docs, work, docs.schema)
    return docs


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(table: str, columns: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"SELECT {columns}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}') AS w FROM {table}"


SQL = f"""
WITH d AS ({_sql_words('documents', 'row_number() OVER () AS rid, doc_id')}),
b AS ({_sql_words('benchmark', "coalesce(CAST(item_id AS VARCHAR), '') AS item")}),
win AS (
  SELECT DISTINCT item, {WINDOW} AS k, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM b WHERE len(w) >= {WINDOW})
  UNION ALL
  SELECT DISTINCT item, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND {WINDOW - 1}
),
ks AS (SELECT DISTINCT k FROM win),
spots AS (SELECT rid, k, unnest(range(1, len(w) - k + 2)) AS p, w FROM d, ks WHERE len(w) >= k),
found AS (
  SELECT s.rid, s.p, s.k, win.item FROM (SELECT rid, k, p, array_to_string(w[p:p + k - 1], ' ') AS t FROM spots) s
  JOIN win ON win.k = s.k AND win.s = s.t
),
hits AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + k)) AS q FROM found) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits h ON h.rid = d.rid LEFT JOIN items i ON i.rid = d.rid
"""
