"""Exact dedup of word windows by difference-cover anchors.

A document is its words, the runs of anything but ASCII white space. Every window of ``LENGTH`` words
that starts anywhere else too, in the same or another document, is removed with all its words.

Only some windows are hashed. A position is an anchor if its number modulo ``PERIOD`` lies in
``COVER``, a difference cover: for any two positions some shift below the period brings both onto the
cover at once. So two equal windows of 35 words always hold equal anchors of ``ANCHOR`` words at the
same place inside, whatever their places in their texts, and one hash for each cover position (five in
21) finds all of them. Anchors that occur once are dropped. The others are extended: the windows of 35
words around them are hashed, 128 bits, and those that start at two places are the repeated ones.

Groups stay small. Within a batch of texts equal hashes are told apart at once, and one of them stands
for all in the shuffle, the others are spread at random. So a hash has at most one row from each batch
in its task, whatever its share of the table, and a stream over the sorted rows judges it with one row
held. Equal texts are one text here; their documents are repeated as a whole by count.

Null text has no words. Texts of fewer than 35 words lose nothing. Repeated rows, with equal or different
ids, are copies of each other. An empty table gives no rows. Other columns are ignored whatever their
names. Two different windows are taken as equal only if 128 bits of hashes collide.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import map_batches, raw_texts
from weirgate.llm.near_dedup import _BASE, _U, mixed, word_hashes
from weirgate.session import cut_lineage

LENGTH = 35
PERIOD = 21
#: A perfect difference set: every difference modulo 21 occurs.
COVER = (3, 6, 7, 12, 14)
ANCHOR = LENGTH - PERIOD + 1
_INVERSE = _U(pow(_BASE, -1, 1 << 64))
_SECOND = _U(0xD6E8FEB86659FD93)


class Words:
    """Hashes of word windows of one text."""

    def __init__(self, text: bytes) -> None:
        self.words = word_hashes(np.frombuffer(text + b" ", np.uint8))[1]
        self.n = len(self.words)
        up = np.full(self.n + 1, _U(_BASE))
        self.down = np.full(self.n + 1, _INVERSE)
        up[0] = self.down[0] = _U(1)
        self.down = np.cumprod(self.down)
        up = np.cumprod(up)[: self.n]
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * up)]) for w in (self.words, mixed(self.words + _SECOND))]

    def windows(self, start: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
        s = self.sums[kind]
        return mixed((s[start + length] - s[start]) * self.down[start])

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places on the cover and the hashes of the words from there; none in texts without a window."""
        if self.n < LENGTH:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = (np.arange(0, self.n, PERIOD)[:, None] + np.array(COVER)).ravel()
        at = at[at <= self.n - ANCHOR]
        return at, self.windows(at, ANCHOR)

    def starts(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of these anchors."""
        edge = np.zeros(self.n + 2, np.int64)
        np.add.at(edge, np.maximum(anchors - (LENGTH - ANCHOR), 0), 1)
        np.add.at(edge, np.minimum(anchors, self.n - LENGTH) + 1, -1)
        return np.flatnonzero(np.cumsum(edge) > 0)


def _emitted(keys: list[int], places: Sequence[np.ndarray], first: Sequence[np.ndarray], second: Sequence[np.ndarray]) -> pa.RecordBatch:
    """Rows of one batch: ``h``, ``g`` (hashes), ``key`` and ``spot``: the place with its two marks.

    Mark 1: the hash is at another place of the batch. Mark 2: another row of the batch stands for it.
    """
    h, g = np.concatenate(first), np.concatenate(second)
    key = np.repeat(np.array(keys, np.int64), [len(p) for p in places])
    place = np.concatenate(places)
    order = np.lexsort((g, h))
    h, g, key, place = h[order], g[order], key[order], place[order]
    fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])]) if len(h) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    several = (np.bincount(group) > 1)[group] if len(h) else fresh
    spot = place * 4 + several + 2 * ~fresh
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (h, g, key, spot)], ["h", "g", "key", "spot"])


_ROWS = "h long, g long, key long, spot long"


def repeated(rows: DataFrame) -> DataFrame:
    """The rows whose hash is at more than one place (``key``, place in ``spot``); marks are taken off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the group that may go on: its hash, one row and whether it has two places
        for batch in filter(len, batches):
            h, g, key, spot = (batch.column(k).to_numpy() for k in ("h", "g", "key", "spot"))
            if held is not None:
                h, g, key, spot = (np.concatenate([[a], b]) for a, b in zip(held[0], (h, g, key, spot)))
            place = spot >> 2
            code = mixed(key.view(np.uint64) + place.astype(np.uint64) * _U(_BASE))
            fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
            first = np.flatnonzero(fresh)
            many = (np.minimum.reduceat(code, first) != np.maximum.reduceat(code, first)) | (np.bitwise_or.reduceat(spot, first) & 1 > 0)
            if held is not None and held[1]:
                many[0] = True
            out = many[np.cumsum(fresh) - 1]
            # The held row of a group that is known to be repeated has been given out already.
            if held is not None and held[1]:
                out[0] = False
            last = first[-1]
            held = ((h[last], g[last], key[last], spot[last]), bool(many[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (h, key, place)], ["h", "key", "place"])

    alone = F.col("spot").bitwiseAND(F.lit(2)) == 0
    dealt = rows.repartition(F.when(alone, F.xxhash64("h", "g")).otherwise(F.xxhash64("key", "spot", "h")))
    return dealt.sortWithinPartitions("h", "g").mapInArrow(run, "h long, key long, place long")


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """Hashes of the anchors of each text, of equal texts of a batch once."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = dict(zip(raw_texts(batch.column("text")), batch.column("key").to_pylist()))
        places, hashes = zip(*(Words(text).anchors() for text in texts))
        return _emitted(list(texts.values()), places, hashes, [np.zeros(len(h), np.uint64) for h in hashes])

    return map_batches(docs.select("key", "text"), work, _ROWS)


def _window_rows(texts: DataFrame) -> DataFrame:
    """Hashes of the windows around the anchors of each text (``key``, ``text`` compressed, ``found``)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdDecompressor()
        keys, places, first, second = [], [], [], []
        for key, text, found in zip(*(batch.column(k).to_pylist() for k in ("key", "text", "found"))):
            words = Words(press.decompress(text))
            asked = {f["place"]: f["h"] for f in found}
            at, h = words.anchors()
            # Texts that share a key by chance are told apart by their hashes.
            mine = [p for p, x in zip(at.tolist(), h.view(np.int64).tolist()) if asked.get(p) == x]
            starts = words.starts(np.array(mine, np.int64)) if mine else np.zeros(0, np.int64)
            keys.append(key)
            places.append(starts)
            first.append(words.windows(starts, LENGTH))
            second.append(words.windows(starts, LENGTH, 1))
        return _emitted(keys, places, first, second)

    return map_batches(texts, work, _ROWS)


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``other`` and the compressed text, which is what travels to a join."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=1)
        texts = pa.array([press.compress(t) for t in raw_texts(batch.column("text"))], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), batch.column("other"), texts], ["doc_id", "key", "other", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, work, f"doc_id {kind}, key long, other long, text binary")


def _keyed(docs: DataFrame) -> DataFrame:
    text: Column = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("other"))


def repeated_words(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` (start, end of each removed run of words) and ``kept`` (the words left, one space between)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = _keyed(docs)
    # A text of 35 words has 69 bytes at least.
    long_ = docs.filter(F.octet_length("text") >= 2 * LENGTH - 1)
    anchors = repeated(_anchor_rows(long_))
    found = cut_lineage(anchors.groupBy("key").agg(F.collect_set(F.struct("place", "h")).alias("found")))
    # One row of each text will do; the second hash keeps texts apart that share a key by chance.
    texts = _packed(long_).groupBy("key", "other").agg(F.first("text").alias("text")).join(found, "key")
    windows = cut_lineage(repeated(_window_rows(texts.select("key", "text", "found"))).select("key", "place", "h"))
    copied = docs.groupBy("key", "other").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    nothing = F.lit(None).cast("struct<place:bigint,h:bigint>")
    hits = windows.select("key", F.struct("place", "h").alias("hit"), F.lit(None).cast("long").alias("other"))
    hits = hits.union(copied.select("key", nothing, "other"))
    hits = hits.groupBy("key").agg(F.collect_set("hit").alias("hits"), F.collect_set("other").alias("copied"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdDecompressor()
        size, spans, kept = [], [], []
        for other, text, hit, whole in zip(*(batch.column(k).to_pylist() for k in ("other", "text", "hits", "copied"))):
            text = press.decompress(text)
            words = text.split()
            n, at = len(words), []
            if n >= LENGTH and whole and other in whole:
                at = [0, n]
            elif n >= LENGTH and hit:
                hashes = Words(text)
                place = np.array([x["place"] for x in hit])
                code = np.array([x["h"] for x in hit])
                right = place <= n - LENGTH
                place, code = place[right], code[right]
                place = place[hashes.windows(place, LENGTH).view(np.int64) == code]
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, place, 1)
                np.add.at(edge, place + LENGTH, -1)
                turn = np.diff(np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)]))
                at = np.stack([np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)], axis=1).ravel().tolist()
            cuts = [0, *at, n]
            size.append(n)
            spans.append(at)
            kept.append(b" ".join(w for a, b in zip(cuts[::2], cuts[1::2]) for w in words[a:b]) if at else b" ".join(words))
        arrays = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "spans", "kept"])

    rows = _packed(docs).join(hits, "key", "left").select("doc_id", "other", "text", "hits", "copied")
    return map_batches(rows, work, f"doc_id {kind}, n_words long, spans array<long>, kept string")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    # Alternating signs: what ends minus what starts.
    ends = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: x - total)
    return found.select("doc_id", "n_words", ends.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


#: Windows are told by the text of their words; a word holds no space.
SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT r, i, md5(array_to_string(words[i:i + 34], ' ')) AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM d WHERE len(words) >= 35)
), hit AS (
  SELECT r, i FROM starts WHERE w IN (SELECT w FROM starts GROUP BY w HAVING count(*) > 1)
), covered AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM hit
), kept AS (
  SELECT d.r, string_agg(d.words[d.i], ' ' ORDER BY d.i) AS kept, count(*) AS n
  FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM d) d
  ANTI JOIN covered USING (r, i) GROUP BY d.r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
