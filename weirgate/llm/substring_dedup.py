"""Exact substring dedup over bytes: every 400-byte string that starts twice is removed everywhere.

Positions are told apart without shuffling them all. In each window of 400 bytes the smallest hash
of its 64-byte strings, the leftmost of equals, is the window's anchor; equal windows have equal
anchors at equal places. Neighbouring starts with one anchor form a segment: its content is the
bytes of all their windows. Segments are counted by (anchor hash, content hash), so copies meet in
the aggregation; a content seen twice is repeated as a whole. What is left are different contents
with one anchor. Their suffixes from the anchor on are sorted by a mergesort that compares in
logarithmic time: polynomial prefix hashes and binary search give the common extension of two
suffixes, to the right for the order and to the left for the match, and every match is verified on
the bytes. Sorted neighbours are followed outward while their common prefix can still make a match.

An anchor with more than ``GROUP`` contents (a passage that very many documents share) is not one
group: its windows are taken in blocks of starts. A block whose whole reach is found twice is
repeated, one whose common core is found once is not, and only the blocks between are counted start
by start. All of that is aggregation by hash, so no anchor ends up in one task.

Null text is empty. Texts under 400 bytes lose nothing. A document that is there twice, with equal
or different ids, is repeated as a whole. An empty table gives no rows. Other columns are ignored.
Span lists are byte positions in the UTF-8 text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import map_batches, raw_texts
from weirgate.llm.near_dedup import _BASE, _TABLE, _U, _powers, mixed
from weirgate.session import cut_lineage

LENGTH = 400
ANCHOR = 64
#: Contents of one anchor that are sorted together.
GROUP = 256
#: Starts of one block of a larger anchor.
BLOCK = 32
#: Bytes whose suffixes are sorted together.
_STRETCH = 1 << 20


class Scan:
    """Segments of one text: ``first`` and ``last`` start, ``anchor`` position, and their hashes."""

    def __init__(self, text: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> None:
        self.length = length
        data = np.frombuffer(text, np.uint8)
        n, w = len(data), length - anchor + 1
        empty = np.zeros(0, np.int64)
        self.first, self.last, self.anchor = empty, empty, empty
        self.anchor_hash = self.content = np.zeros(0, np.uint64)
        if n < length:
            return
        self.prefix, self.down = prefix_hashes(data)
        grams = mixed((self.prefix[anchor:] - self.prefix[:-anchor]) * self.down[: n - anchor + 1])
        first, last, at = [], [], []
        i, end = 0, n - length
        while i <= end:
            p = i + int(grams[i : i + w].argmin())
            # The anchor holds until it leaves the window or a smaller one enters.
            stop = min(p, end)
            later = grams[i + w : stop + w] < grams[p]
            k = int(later.argmax()) if len(later) else 0
            if len(later) and later[k]:
                stop = i + k
            first.append(i)
            last.append(stop)
            at.append(p)
            i = stop + 1
        self.first, self.last, self.anchor = np.array(first), np.array(last), np.array(at)
        self.anchor_hash = grams[self.anchor]
        self.content = self.hashes(self.first, self.last + length)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte values times powers, and the inverse powers."""
    up, down = _powers(len(data) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[: len(data)])]), down


class Suffixes:
    """Contents laid end to end, with prefix hashes for comparing suffixes at their anchors."""

    def __init__(self, contents: list[bytes], offsets: np.ndarray) -> None:
        self.text = b"".join(contents)
        self.data = np.frombuffer(self.text, np.uint8)
        base = np.cumsum([0] + [len(c) for c in contents])
        self.low, self.high, self.at = base[:-1], base[1:], base[:-1] + offsets
        self.prefix, self.down = prefix_hashes(self.data)

    def _equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        p, d = self.prefix, self.down
        return (p[a + n] - p[a]) * d[a] == (p[b + n] - p[b]) * d[b]

    def _longest(self, most: np.ndarray, equal) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = equal(mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at the anchors of contents i and j have in common."""
        a, b = self.at[i], self.at[j]
        return self._longest(np.minimum(self.high[i] - a, self.high[j] - b), lambda n: self._equal(a, b, n))

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The same to the left of the anchors."""
        a, b = self.at[i], self.at[j]
        return self._longest(np.minimum(a - self.low[i], b - self.low[j]), lambda n: self._equal(a - n, b - n, n))

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the suffix of i is smaller than that of j; a prefix is smaller than its extension."""
        n = self.right(i, j)
        x, y = self.at[i] + n, self.at[j] + n
        i_ends, j_ends = x >= self.high[i], y >= self.high[j]
        top = len(self.data) - 1
        less = self.data[np.minimum(x, top)] < self.data[np.minimum(y, top)]
        return np.where(i_ends | j_ends, i_ends & ~j_ends, less)

    def sorted_groups(self, sizes: np.ndarray) -> np.ndarray:
        """Mergesort within each of the groups of contents that lie in order."""
        order = np.arange(sizes.sum())
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.arange(len(order)) - start
        size = np.repeat(sizes, sizes)
        width = 1
        while width < sizes.max(initial=1):
            run = place // width
            left = run % 2 == 0
            # Bounds of the run that each element's run is merged with.
            low = start + np.where(left, (run + 1) * width, (run - 1) * width)
            end = np.minimum(low + width, start + size)
            low = np.minimum(low, end)
            first = low.copy()
            high = end
            while (open_ := low < high).any():
                at = np.flatnonzero(open_)
                mid = (low[at] + high[at]) // 2
                mine, other = order[at], order[mid]
                # Equal suffixes keep their order: a left one goes before a right one.
                ahead = np.where(left[at], self.before(other, mine), ~self.before(mine, other))
                low[at] = np.where(ahead, mid + 1, low[at])
                high = high.copy()
                high[at] = np.where(ahead, high[at], mid)
            pair = start + (run // 2) * 2 * width
            to = pair + place % width + (low - first)
            merged = np.empty_like(order)
            merged[to] = order
            order = merged
            width *= 2
        return order


def repeated_starts(groups: list[list[tuple[bytes, int]]], length: int = LENGTH) -> list[list[list[int]]]:
    """For groups of different (content, anchor place): the ranges of starts whose window another content has too."""
    sizes = np.array([len(g) for g in groups])
    flat = [c for g in groups for c in g]
    s = Suffixes([c for c, _ in flat], np.array([o for _, o in flat]))
    order = s.sorted_groups(sizes)
    group = np.repeat(np.arange(len(groups)), sizes)
    found: list[list[tuple[int, int]]] = [[] for _ in flat]
    room = (s.at - s.low)[order]
    # Room does not fall with distance as reach does: a place is followed while the largest room of its group would do.
    most = np.zeros(len(groups), np.int64)
    np.maximum.at(most, group, room)
    first, step = np.arange(len(order) - 1), 1
    next_ = s.right(order[:-1], order[1:]) if len(order) > 1 else np.zeros(0, np.int64)
    reach = next_
    while True:
        inside = first + step < len(order)
        first, reach = first[inside], reach[inside]
        reach = np.minimum(reach, next_[first + step - 1])
        open_ = (group[first] == group[first + step]) & (reach + most[group[first]] >= length)
        first, reach = first[open_], reach[open_]
        if not len(first):
            break
        active = reach + np.minimum(room[first], room[first + step]) >= length
        i, j = order[first[active]], order[first[active] + step]
        right, left = reach[active], s.left(i, j)
        for a, b, r, l in zip(*(x[left + right >= length].tolist() for x in (i, j, right, left))):
            x, y = int(s.at[a]), int(s.at[b])
            if s.text[x - l : x + r] != s.text[y - l : y + r]:
                l, r = _plain(s, a, b)
                if l + r < length:
                    continue
            for k, at in ((a, x), (b, y)):
                place = at - int(s.low[k])
                found[k].append((place - l, place - max(0, length - r)))
        step += 1
    out = iter(united(f) for f in found)
    return [[next(out) for _ in g] for g in groups]


def _plain(s: Suffixes, a: int, b: int) -> tuple[int, int]:
    """Common extensions byte by byte, for the case of a hash collision."""
    x, y = int(s.at[a]), int(s.at[b])
    left = right = 0
    while x - left > s.low[a] and y - left > s.low[b] and s.text[x - left - 1] == s.text[y - left - 1]:
        left += 1
    while x + right < s.high[a] and y + right < s.high[b] and s.text[x + right] == s.text[y + right]:
        right += 1
    return left, right


def united(ranges: list[tuple[int, int]]) -> list[int]:
    """Overlapping or touching ranges as one; first and last of each in one list."""
    out: list[int] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1] + 1:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def segments(texts: DataFrame) -> DataFrame:
    """``key``, ``a`` (anchor hash), ``c`` (content hash) and ``n`` (times in the text), from ``key`` and ``text``."""

    def work(batch: pa.RecordBatch):
        keys, a, c, n = [], [], [], []
        for key, text in zip(batch.column("key").to_pylist(), raw_texts(batch.column("text"))):
            s = Scan(text)
            if len(s.first):
                both, count = np.unique(np.stack([s.anchor_hash, s.content]), axis=1, return_counts=True)
                keys.append(np.full(len(count), key))
                a.append(both[0])
                c.append(both[1])
                n.append(count)
        if keys:
            parts = [np.concatenate(x).view(np.int64) for x in (keys, a, c, n)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts], ["key", "a", "c", "n"])

    return map_batches(texts, work, "key long, a long, c long, n long")


def packed(docs: DataFrame) -> DataFrame:
    """``key`` and the compressed text, which is what travels to a join."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=1)
        texts = [press.compress(t) for t in raw_texts(batch.column("text"))]
        rest = [batch.column(k) for k in names if k != "text"]
        return pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.binary())], [*[k for k in names if k != "text"], "text"])

    names = docs.columns
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text"]
    return map_batches(docs, work, ", ".join([*kinds, "text binary"]))


def _fetch(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of wanted contents (``key``, ``a``, ``c``, ``many``) from one text that has them."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("a", "c", "many")).alias("wanted"))
    # One row of each text will do; the second hash keeps texts apart that share a key by chance.
    texts = packed(docs.select("key", F.xxhash64(F.lit(1), "text").alias("other"), "text"))
    texts = texts.groupBy("key", "other").agg(F.first("text").alias("text")).join(lists, "key")

    def work(batch: pa.RecordBatch):
        press = zstandard.ZstdDecompressor()
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            text = press.decompress(text)
            s, a, c, many, body, offset = Scan(text), [], [], [], [], []
            asked = {(w["a"], w["c"]): w["many"] for w in wanted}
            for i, pair in enumerate(zip(s.anchor_hash.view(np.int64).tolist(), s.content.view(np.int64).tolist())):
                if pair in asked:
                    a.append(pair[0])
                    c.append(pair[1])
                    many.append(asked.pop(pair))
                    body.append(text[s.first[i] : s.last[i] + s.length])
                    offset.append(int(s.anchor[i] - s.first[i]))
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(many, pa.bool_()), pa.array(body, pa.binary()), pa.array(offset, pa.int64())],
                    ["a", "c", "many", "body", "offset"],
                )

    return map_batches(texts.select("text", "wanted"), work, "a long, c long, many boolean, body binary, offset long")


def _sorted(contents: DataFrame) -> DataFrame:
    """Ranges of repeated starts by suffix sort, for anchors of at most ``GROUP`` contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total = 0

        def settled(rows: list[tuple]) -> pa.RecordBatch:
            groups: list[list[tuple]] = []
            for row in rows:
                if groups and groups[-1][0][0] == row[0]:
                    groups[-1].append(row)
                else:
                    groups.append([row])
            groups = [g for g in groups if len(g) > 1]
            ranges = repeated_starts([[(r[2], r[3]) for r in g] for g in groups]) if groups else []
            out = [(r[0], r[1], x) for g, xs in zip(groups, ranges) for r, x in zip(g, xs) if x]
            a, c, x = zip(*out) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(x, pa.list_(pa.int32()))], ["a", "c", "ranges"])

        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in ("a", "c", "body", "offset")))
            for row in rows:
                # Texts that share a key by chance may send a content twice.
                if held and held[-1][:2] == row[:2]:
                    continue
                if total >= _STRETCH and row[0] != held[-1][0]:
                    yield settled(held)
                    held, total = [], 0
                held.append(row)
                total += len(row[2])
        if held:
            yield settled(held)

    rows = contents.select("a", "c", "body", "offset").repartition("a").sortWithinPartitions("a", "c")
    return rows.mapInArrow(run, "a long, c long, ranges array<int>")


def _blocks(contents: DataFrame) -> DataFrame:
    """Ranges of repeated starts of anchors with very many contents, by counts of hashes."""

    def hashed(single: bool):
        def work(batch: pa.RecordBatch):
            a, c, block, core, hull, low, high = [], [], [], [], [], [], []
            ask = batch.column("block").to_pylist() if single else [None] * batch.num_rows
            for x, y, body, offset, only in zip(*(batch.column(k).to_pylist() for k in ("a", "c", "body", "offset")), ask):
                data = np.frombuffer(body, np.uint8)
                prefix, down = prefix_hashes(data)
                starts = len(body) - LENGTH
                # Starts are told by their distance before the anchor, which equal windows share.
                far, near = offset, offset - starts
                size = 1 if single else BLOCK
                first = np.arange(near // size, far // size + 1)
                if single:
                    first = first[first // BLOCK == only]
                nearest, farthest = np.maximum(first * size, near), np.minimum(first * size + size - 1, far)
                lo, hi = offset - farthest, offset - nearest

                def value(start, end, kind, d):
                    h = (prefix[end] - prefix[start]) * down[start]
                    return mixed(mixed(h + _U(kind)) + (offset - start).astype(np.uint64) * _U(_BASE) + d.astype(np.uint64))

                # What all windows of the whole block share, so any of them in this content has it.
                shared = offset - first * size
                core.append(value(shared, shared - size + 1 + LENGTH, 1, first))
                hull.append(value(lo, hi + LENGTH, 2, first) if not single else core[-1])
                a.append(np.full(len(first), x))
                c.append(np.full(len(first), y))
                block.append(first)
                low.append(lo)
                high.append(hi)
            cols = [np.concatenate(v).view(np.int64) for v in (a, c, block, core, hull, low, high)]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in cols], names)

        return work

    names = ["a", "c", "block", "core", "hull", "low", "high"]
    schema = ", ".join(f"{n} long" for n in names)

    def counted(rows: DataFrame, column: str, name: str) -> DataFrame:
        twice = rows.groupBy("a", F.col(column).alias(column)).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
        return rows.join(twice.select("a", column, F.lit(True).alias(name)), ["a", column], "left")

    contents = contents.select("a", "c", "body", "offset").dropDuplicates(["a", "c"])
    blocks = cut_lineage(map_batches(contents, hashed(False), schema))
    judged = cut_lineage(counted(counted(blocks, "core", "maybe"), "hull", "surely"))
    whole = judged.filter("surely").select("a", "c", "low", "high")
    # The core of a block is in all its windows: found once, no window is repeated.
    unsure = judged.filter("maybe AND surely IS NULL")
    # Their partners may lie in repeated blocks, of which one of each kind is enough.
    sure = judged.filter("surely").join(unsure.select("a", "core").distinct(), ["a", "core"], "left_semi")
    partners = sure.groupBy("a", "block", "hull").agg(F.min("c").alias("c"))
    asked = unsure.select("a", "c", "block").union(partners.select("a", "c", "block"))
    open_ = contents.join(asked, ["a", "c"])
    singles = cut_lineage(map_batches(open_.select("a", "c", "body", "offset", "block"), hashed(True), schema))
    parts = whole.union(counted(singles, "core", "sure").filter("sure").select("a", "c", "low", "high"))

    def unite(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [united([(r["low"], r["high"]) for r in rs]) for rs in batch.column("parts").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("c"), pa.array(x, pa.list_(pa.int32()))], ["a", "c", "ranges"])

    # A content has at most LENGTH - ANCHOR + 1 starts.
    lists = parts.groupBy("a", "c").agg(F.collect_list(F.struct("low", "high")).alias("parts"))
    return map_batches(lists, unite, "a long, c long, ranges array<int>")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (start, end of each removed run) and ``kept`` (the bytes left), of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Texts that share a key by chance share their lists, which changes nothing: lists name contents.
    docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"))
    long_ = docs.filter(F.octet_length("text") >= LENGTH)
    found = cut_lineage(segments(long_.select("key", "text")))
    contents = cut_lineage(found.groupBy("a", "c").agg(F.sum("n").alias("n"), F.min("key").alias("key")))
    several = contents.groupBy("a").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    wanted = contents.filter("n = 1").join(several, "a").select("key", "a", "c", (F.col("m") > GROUP).alias("many"))
    # Contents that are repeated as a whole still are partners of the others.
    partners = contents.filter("n > 1").join(several, "a").select("key", "a", "c", (F.col("m") > GROUP).alias("many"))
    bodies = cut_lineage(_fetch(wanted.union(partners), long_))
    ranges = _sorted(bodies.filter(~F.col("many"))).union(_blocks(bodies.filter("many")))
    whole = contents.filter("n > 1").select("a", "c", F.lit(None).cast("array<int>").alias("ranges"))
    known = cut_lineage(whole.union(ranges.join(whole.select("a", "c"), ["a", "c"], "left_anti")))
    lists = found.select("key", "a", "c").distinct().join(known, ["a", "c"]).groupBy("key").agg(F.collect_list(F.struct("a", "c", "ranges")).alias("hits"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdDecompressor()
        spans, kept, size = [], [], []
        for text, hits in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist()):
            text = press.decompress(text)
            marks = np.zeros(len(text) + 1, np.int32)
            if hits:
                asked = {(h["a"], h["c"]): h["ranges"] for h in hits}
                s = Scan(text)
                for i, pair in enumerate(zip(s.anchor_hash.view(np.int64).tolist(), s.content.view(np.int64).tolist())):
                    if pair in asked:
                        got = asked[pair] or [0, int(s.last[i] - s.first[i])]
                        for a, b in zip(got[::2], got[1::2]):
                            marks[s.first[i] + a] += 1
                            marks[s.first[i] + b + LENGTH] -= 1
            edge = np.diff(np.concatenate([[0], (np.cumsum(marks) > 0).astype(np.int8)]))
            at = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1).ravel().tolist()
            cuts = [0, *at, len(text)]
            spans.append(at)
            kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
            size.append(len(text))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )

    rows = packed(docs).join(lists, "key", "left").select("doc_id", "text", "hits")
    return map_batches(rows, work, f"doc_id {kind}, n_bytes long, spans array<long>, kept binary")


def digest(spans: DataFrame) -> DataFrame:
    """The contract's columns."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("spans").to_pylist()
        removed = [sum(b - a for a, b in zip(x[::2], x[1::2])) for x in lists]
        shas = [hashlib.sha256(k).hexdigest() for k in batch.column("kept").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array([len(x) // 2 for x in lists], pa.int64()), pa.array(shas)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    kind = spans.schema["doc_id"].dataType.simpleString()
    return map_batches(spans, work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
