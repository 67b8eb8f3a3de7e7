"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters slide over the UTF-8 bytes of the whole text. Overlapping chunks (``CHUNK`` bytes,
one starts at every half of it) are max-pooled; the mean and the maximum of the pooled responses over all
chunks of a document go into one logistic unit, whose output is the probability of label 1.

The network is fitted with Adam on a bounded sample of labelled rows of the training folds: about
``sample`` rows of each label, drawn by a hash, of texts up to ``longest`` bytes. Rows are weighted
so that the sample keeps the share of each label. Scoring reads every document whole.

Null and empty texts are scored as one chunk without bytes. Labels that are null or not 0 or 1 are
left out, labels of unknown documents too; without two labels all scores are the share of label 1
(0.5 without any). A null id counts as the empty text when folds are made. Repeated documents each
get their row; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import fold, map_batches, raw_texts

CHUNK = 512
HALF = CHUNK // 2
FILTERS = 16
WIDTH = 4
SAMPLE = 800
LONGEST = 65_536
THRESHOLD = 0.3
#: Bytes that are convolved at once.
_STRETCH = 1 << 19


@dataclass
class Net:
    """Filters by place, byte and filter; their biases; weights of mean and maximum; bias."""

    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    last: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.out, self.last]


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text padded to whole half chunks with the filter's width to spare; first half of each text."""
    sizes = [-(-max(len(t) + WIDTH - 1, 1) // HALF) * HALF for t in texts]
    data = np.zeros(sum(sizes) + WIDTH, np.uint8)
    starts = np.cumsum([0] + sizes)
    for t, at in zip(texts, starts):
        data[at : at + len(t)] = np.frombuffer(t, np.uint8)
    return data, starts // HALF


def responses(net: Net, data: np.ndarray, halves: int, ends: np.ndarray) -> np.ndarray:
    """Filter responses at each byte, as (half, place in it, filter); windows over a text's end do not count."""
    n = halves * HALF
    out = net.filters[0][data[:n]]
    for j in range(1, WIDTH):
        out += net.filters[j][data[j : n + j]]
    out = out.reshape(-1, HALF, FILTERS)
    out[ends - 1, HALF - WIDTH + 1 :] = -1e9
    return out


def chunks_of(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First half of each chunk and the first chunk of each text; a text of one half is one chunk."""
    n = np.diff(halves)
    count = np.maximum(n - 1, 1)
    first = np.concatenate([np.arange(a, a + c) for a, c in zip(halves[:-1], count)])
    return first, np.concatenate([[0], np.cumsum(count)])


def pooled(best: np.ndarray, halves: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rectified maxima by chunk; which half won; first half of each chunk; first chunk of each text."""
    first, texts = chunks_of(halves)
    single = np.isin(first + 1, halves)
    second = np.where(single, first, first + 1)
    won = np.where(best[second] > best[first], second[:, None], first[:, None])
    top = np.maximum(best[first], best[second]) + bias
    return np.maximum(top, 0), won, first, texts


def features(chunk: np.ndarray, texts: np.ndarray) -> np.ndarray:
    count = np.diff(texts)[:, None]
    return np.concatenate([np.add.reduceat(chunk, texts[:-1]) / count, np.maximum.reduceat(chunk, texts[:-1])], axis=1)


def scores(net: Net, texts: list[bytes]) -> np.ndarray:
    """Probabilities of label 1; long texts are convolved in stretches of whole halves."""
    if not texts:
        return np.zeros(0)
    data, halves = laid_out(texts)
    best = np.empty((halves[-1], FILTERS), np.float32)
    for a in range(0, halves[-1], _STRETCH // HALF):
        b = min(a + _STRETCH // HALF, halves[-1])
        ends = halves[(halves > a) & (halves <= b)] - a
        best[a:b] = responses(net, data[a * HALF : b * HALF + WIDTH], b - a, ends).max(axis=1)
    chunk, _, _, first = pooled(best, halves, net.bias)
    z = features(chunk, first) @ net.out + net.last[0]
    return 1 / (1 + np.exp(-z.clip(-30, 30)))


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = 14, batch: int = 48, rate: float = 0.01) -> Net:
    """Adam on the weighted logistic loss; gradients pass a maximum to the byte that won it."""
    rng = np.random.default_rng(5)
    net = Net(
        rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    )
    share = float((weights * labels).sum() / weights.sum())
    if not 0 < share < 1:
        net.out[:] = 0
        net.last[0] = 30.0 if share else -30.0
        return net
    net.last[0] = np.log(share / (1 - share))
    m = [np.zeros_like(a) for a in net.arrays()]
    v = [np.zeros_like(a) for a in net.arrays()]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            at = order[i : i + batch]
            data, halves = laid_out([texts[k] for k in at])
            out = responses(net, data, halves[-1], halves[1:])
            where = out.argmax(axis=1)
            best = np.take_along_axis(out, where[:, None, :], axis=1)[:, 0]
            chunk, won, _, first = pooled(best, halves, net.bias)
            x = features(chunk, first)
            p = 1 / (1 + np.exp(-(x @ net.out + net.last[0]).clip(-30, 30)))
            g = ((p - labels[at]) * weights[at] / weights[at].sum()).astype(np.float32)
            back = g[:, None] * net.out[None, :]
            owner = np.repeat(np.arange(len(at)), np.diff(first))
            g_chunk = back[owner, :FILTERS] / np.diff(first)[owner, None]
            g_chunk += back[owner, FILTERS:] * (chunk == x[owner, FILTERS:])
            g_chunk *= chunk > 0
            f = np.broadcast_to(np.arange(FILTERS), won.shape)
            byte = won * HALF + where[won, f]
            grads = [np.zeros_like(a) for a in net.arrays()]
            for j in range(WIDTH):
                np.add.at(grads[0][j], (data[byte + j], f), g_chunk)
            grads[1][:] = g_chunk.sum(axis=0)
            grads[2][:] = x.T @ g + 1e-4 * net.out
            grads[3][0] = g.sum()
            step += 1
            for a, d, mm, vv in zip(net.arrays(), grads, m, v):
                mm += 0.1 * (d - mm)
                vv += 0.001 * (d * d - vv)
                a -= rate * (0.3 if epoch > epochs * 2 // 3 else 1) * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    return net


def train(docs: DataFrame, labels: DataFrame, allowed: F.Column, sample: int = SAMPLE, longest: int = LONGEST) -> Net:
    """``docs`` with ``doc_id`` and ``text``; ``labels`` with ``doc_id`` and ``quality``."""
    marked = labels.filter(allowed & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    sizes = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = {q: min(1.0, sample / n) for q, n in sizes.items()}
    keep = F.lit(False)
    for q, r in rate.items():
        keep = F.when(F.col("quality") == q, F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(r * 1_000_000)).otherwise(keep)
    # About ``sample`` ids of each label: small enough to send to the tasks, so texts stay where they are.
    drawn = F.broadcast(marked.filter(keep).groupBy("doc_id").agg(F.max("quality").alias("quality")))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", text.alias("text")).filter(F.octet_length("text") <= longest).join(drawn, "doc_id")
    # One row of each id, however often it is repeated: what is collected is bounded by ``sample``.
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["text"])))
    if not rows:
        net = fit([b""], np.ones(1), np.ones(1), epochs=0)
        net.last[0] = 0.0
        return net
    y = np.array([r["quality"] for r in rows], np.float32)
    weights = np.array([1 / rate[r["quality"]] for r in rows], np.float32)
    return fit([bytes(r["text"]) for r in rows], y, weights / weights.mean())


def quality_scores(docs: DataFrame, labels: DataFrame, fold_parts: int = 5, sample: int = SAMPLE, longest: int = LONGEST, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out`` (fold 0), ``score`` and ``predicted`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fold("doc_id", fold_parts) != 0, sample, longest))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw_texts(batch.column("text"))
        some = [scores(shared.value, texts[i : i + 200]) for i in range(0, len(texts), 200)]
        score = np.concatenate(some).astype(np.float64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (fold("doc_id", fold_parts) == 0).alias("held_out"))
    return map_batches(rows, work, f"doc_id {kind}, held_out boolean, score double, predicted int")
