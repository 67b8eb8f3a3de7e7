"""Scores of texts under a log-bilinear model of words.

Words are lower-cased in A-Z and cut at ASCII white space; each text closes with one end token.
The model predicts a word from the two words before it. Its vocabulary grows with the corpus: every
training word that occurs ``least`` times, or ``root`` times the square root of the number of tokens where
that is more, of at most a dictionary's worth (a bound for what goes to the tasks; where it is reached,
the threshold rises), the end, and ``rare`` symbols that stand for the other
words by their ending. A rarer word's probability is that of its symbol times its smoothed share among the
words of that symbol, where one place is left for unknown words; so the probabilities of all words add
up to 1.

Each word has a vector as context and one as target. Targets are kept in blocks in order of frequency, small ones
for the frequent words, and a word's probability is that of its block times its own within
the block: two log-bilinear models, each normalised exactly by batched matrix products, one of all contexts
with the blocks, one of the contexts of a block's words with that block.

Texts become symbols in one pass that writes them down; training and scoring read those.

Training is numpy with noise-contrastive estimation at both levels, inside the tasks that read the
symbols. Counts, shares and the vocabulary come from all tokens, and so do the steps: every training
document is dealt to one of ``rounds`` rounds by a hash, and each of its tokens takes part in one step. A
round has one shard for about ``shard_tokens`` tokens; each trains a copy, and what comes back is summed
by row of the model: the change of a row is averaged with the weight of the gradient it saw. A task takes so
many shards, one after the other, that their sums are small beside the tokens it read. A step takes
``batch`` consecutive tokens, up to four times as many in a large corpus.

Null and empty texts are an end token alone. A null id counts as the empty text when folds are
made. Repeated documents each get their row; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import fold, let_go, map_batches, numbered, slices
from weirgate.llm.frequencies import DICTIONARY, frequent, tallied
from weirgate.session import CLEAN_SHUFFLES, cut_lineage, setting

#: Stands for the end token among words; no word holds a line end.
END = b"\n"
SMOOTHING = 0.1
#: Tokens that are scored or shuffled for training together.
CHUNK = 1 << 16
#: Multiplications of one matrix product: few enough that the library stays on the task's own core, as
#: threads of its own would compete with the other tasks.
PRODUCT = 1 << 18
#: Scores that are worked on together.
CACHED = 1 << 17
#: Tokens of a block that share their noise words in a step.
GROUP = 64
#: Bytes of texts that are cut into words together.
CUT = 4 << 20
#: A task trains shards until it has read as many tokens as this for each symbol, of which it returns three rows.
READ = 160
#: Tasks of a round, where it has as many shards.
TASKS = 8


@dataclass(frozen=True)
class Shape:
    """Size of the model and of its training."""

    least: int = 10
    root: float = 0.02
    rare: int = 256
    width: int = 16
    block_noise: int = 32
    word_noise: int = 16
    rounds: int = 2
    share: float = 1
    shard_tokens: int = 4_000_000
    task_shards: int = 1
    batch: int = 4096
    rate: float = 0.1


def ending(word: bytes, rare: int) -> int:
    return zlib.crc32(word[-2:]) % rare


class Vocabulary:
    """Symbols in order of frequency: words, the end, and those that stand for rarer words (``rare_symbol`` by ending)."""

    def __init__(self, words: dict[bytes, int], rare_n: np.ndarray) -> None:
        # The end and the rare symbols are always there, if only with the weight of the smoothing.
        entries = [(float(n), w) for w, n in words.items()] + [(float(n) + SMOOTHING, b" %d" % e) for e, n in enumerate(rare_n)]
        entries.sort(key=lambda x: (-x[0], x[1]))
        self.symbol = {w: i for i, (_, w) in enumerate(entries) if not w.startswith(b" ")}
        of_rare = {int(w): i for i, (_, w) in enumerate(entries) if w.startswith(b" ")}
        self.rare_symbol = np.array([of_rare[e] for e in range(len(rare_n))])
        self.end = self.symbol[END]
        self.size = len(entries)
        count = np.array([n for n, _ in entries])
        # Sizes by the root of the rank: frequent words have few neighbours to be normalised against.
        first = [0]
        while first[-1] < self.size:
            first.append(min(self.size, first[-1] + max(8, int(3.3 * np.sqrt(first[-1])))))
        self.first = np.array(first)
        self.block = np.repeat(np.arange(len(first) - 1), np.diff(first))
        total = np.add.reduceat(count, self.first[:-1])
        self.upto = np.concatenate([[0.0], np.cumsum(count)])
        self.block_p, self.word_p = total / total.sum(), count / total[self.block]

    def bare(self) -> Vocabulary:
        """The same without the words, for tasks that work on symbols."""
        out = copy.copy(self)
        out.symbol = {}
        return out

    @property
    def stored(self) -> str:
        """How symbols are written down."""
        return "<u2" if self.size <= 1 << 16 else "<u4"

    @property
    def blocks(self) -> int:
        return len(self.block_p)

    @property
    def start(self) -> int:
        """The context before the first word."""
        return self.size


def contexts(sym: np.ndarray, starts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two places back, over texts laid end to end that begin at ``starts``."""
    one = np.empty_like(sym)
    one[1:] = sym[:-1]
    one[starts] = start
    two = np.empty_like(sym)
    two[1:] = one[:-1]
    two[starts] = start
    return one, two


#: Tables of the model; all but the places have one row a symbol or block, and ``bias`` and ``block_bias`` one column.
TABLES = ("before", "after", "bias", "block", "block_bias", "places")


class Model:
    """Log-bilinear parameters: context vectors, target and block vectors with biases, one matrix a place."""

    def __init__(self, tables: dict[str, np.ndarray]) -> None:
        self.tables = tables

    @classmethod
    def fresh(cls, v: Vocabulary, width: int) -> Model:
        rng = np.random.default_rng(7)
        tables = {
            "before": rng.normal(0, 0.3, (v.size + 1, width)),
            "after": rng.normal(0, 0.05, (v.size, width)),
            "bias": np.log(v.word_p)[:, None],
            "block": rng.normal(0, 0.05, (v.blocks, width)),
            "block_bias": np.log(v.block_p)[:, None],
            "places": np.concatenate([np.eye(width), 0.5 * np.eye(width)]),
        }
        return cls({k: x.astype(np.float32) for k, x in tables.items()})

    def query(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        t = self.tables
        return product(np.hstack([t["before"][one], t["before"][two]]), t["places"])

    def log_probability(self, v: Vocabulary, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log-probability of each word after its context."""
        t, block = self.tables, v.block[word]
        query = self.query(one, two)
        longest = float(np.sqrt(np.einsum("bd,bd->b", query, query).max()))
        query = np.column_stack([query, np.ones(len(query), np.float32)])  # for the bias
        out = _log_softmax(query, t["block"], t["block_bias"][:, 0], block, longest)
        order = _sorting(block, v.blocks)
        edge = np.searchsorted(block[order], np.arange(v.blocks + 1))
        for b in np.flatnonzero(np.diff(edge)).tolist():
            at, low, high = order[edge[b] : edge[b + 1]], v.first[b], v.first[b + 1]
            out[at] += _log_softmax(query[at], t["after"][low:high], t["bias"][low:high, 0], word[at] - low, longest)
        return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` in pieces of ``PRODUCT``."""
    rows = max(1, PRODUCT // b.size)
    return np.concatenate([a[i : i + rows] @ b for i in range(0, len(a), rows)])


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` in pieces of ``PRODUCT``."""
    rows = max(1, PRODUCT // (a.shape[1] * b.shape[1]))
    return sum(a[i : i + rows].T @ b[i : i + rows] for i in range(0, len(a), rows))


def _log_softmax(query: np.ndarray, vectors: np.ndarray, bias: np.ndarray, pick: np.ndarray, longest: float) -> np.ndarray:
    """Log-probability of one target for each query, which ends in a one; ``longest``: no query has a larger norm without it."""
    out = np.empty(len(query), np.float32)
    turned = np.vstack([vectors.T, bias])
    # Where no score can get large, exponentials are safe as they are.
    small = longest * float(np.sqrt((vectors * vectors).sum(axis=1).max())) + float(np.abs(bias).max()) < 60
    rows = max(1, PRODUCT // turned.size)
    # What is not a product works on all that a core's cache holds.
    many = rows * max(1, CACHED // (rows * len(vectors)))
    number, ones = np.arange(many), np.ones(len(vectors), np.float32)
    scores = np.empty((min(many, len(query)), len(vectors)), np.float32)
    for i in range(0, len(query), many):
        some = query[i : i + many]
        z = scores[: len(some)]
        for j in range(0, len(some), rows):
            np.matmul(some[j : j + rows], turned, out=z[j : j + rows])
        if not small:
            z -= z.max(axis=1, keepdims=True)
        got = z[number[: len(z)], pick[i : i + many]]
        np.exp(z, out=z)
        out[i : i + many] = got - np.log(z @ ones)
    return out


def _sorting(index: np.ndarray, size: int) -> np.ndarray:
    """Order of the numbers below ``size``; sixteen bits are sorted by radix."""
    return np.argsort(index.astype(np.uint16) if size <= 1 << 16 else index, kind="stable")


def _changes(rows: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))


def _run_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows that begin at ``first``; most have one row, which is not summed."""
    size = np.diff(first, append=len(values))
    out = values[first]
    longer = size > 1
    if longer.any():
        size_of = size[longer]
        out[longer] = np.add.reduceat(values[np.repeat(longer, size)], np.cumsum(size_of) - size_of, axis=0)
    return out


def _by_row(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values of equal rows."""
    order = _sorting(index, int(index.max()) + 1)
    rows = index[order]
    first = _changes(rows)
    return rows[first], _run_sums(values[order], first)


def _errors(true: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the classifier of data against noise is off: for the words, and for the noise, in its own place."""
    with np.errstate(over="ignore"):  # 1 / infinity is what it should be
        np.negative(noise, out=noise)
        np.exp(noise, out=noise)
        noise += 1
        np.divide(-1, noise, out=noise)
        return 1 / (1 + np.exp(true)), noise


class Trainer:
    """Adagrad steps on the noise-contrastive loss of both levels."""

    def __init__(self, model: Model, v: Vocabulary, shape: Shape, seed: int) -> None:
        self.v, self.shape, self.rng = v, shape, np.random.default_rng(seed)
        self.tables = {k: x.copy() for k, x in model.tables.items()}
        self.past = {k: np.full_like(x, 1e-3) for k, x in self.tables.items()}
        self.model = Model(self.tables)
        self.block_upto = np.cumsum(v.block_p)
        self.block_offset = np.log(shape.block_noise * v.block_p).astype(np.float32)
        self.word_offset = np.log(shape.word_noise * v.word_p).astype(np.float32)

    def _move(self, table: str, rows, gradient: np.ndarray) -> None:
        past = self.past[table][rows]
        past += gradient * gradient
        self.past[table][rows] = past
        self.tables[table][rows] += self.shape.rate * gradient / np.sqrt(past)

    def step(self, sym: np.ndarray, starts: np.ndarray, ahead: np.ndarray) -> None:
        """One step on consecutive tokens; texts begin at ``starts``, and ``ahead`` are the two symbols before them."""
        t, v, n, k = self.tables, self.v, len(sym), self.shape.word_noise
        # Each token's context vector is read once and serves the two tokens that follow.
        row = np.concatenate([ahead, sym])
        vectors = t["before"][row]
        width = vectors.shape[1]
        near = np.hstack([vectors[1:-1], vectors[:-2]])
        second = np.setdiff1d(starts + 1, np.append(starts, n))  # a text may be one token
        near[starts, :width] = near[starts, width:] = near[second, width:] = t["before"][v.start]
        # Sorted by word: tokens of a word and of a block lie together.
        order = _sorting(sym, v.size)
        word, near = sym[order], near[order]
        query = product(near, t["places"])
        # Blocks: one set of noise blocks serves the whole step, so scores are matrix products.
        block = v.block[word]
        first_word, first = _changes(word), _changes(block)
        words, blocks, size = word[first_word], block[first], np.diff(first, append=n)
        drawn = np.searchsorted(self.block_upto, self.rng.random(self.shape.block_noise)).clip(0, v.blocks - 1)
        bias = t["block_bias"][:, 0] - self.block_offset
        vectors = t["block"][block]
        true, noise = _errors(np.einsum("bd,bd->b", query, vectors) + bias[block], product(query, t["block"][drawn].T) + bias[drawn])
        back = product(noise, t["block"][drawn])
        vectors *= true[:, None]
        back += vectors
        pulled = np.add.reduceat(np.column_stack([query * true[:, None], true]), first, axis=0)
        for_blocks = _by_row(np.concatenate([blocks, drawn]), np.vstack([pulled, np.column_stack([inner(noise, query), noise.sum(axis=0)])]))
        # Words: noise words come from the block, by frequency, and serve ``GROUP`` tokens of it.
        groups = -(-size // GROUP)
        place = np.arange(n) + np.repeat((np.cumsum(groups) - groups) * GROUP - first, size)
        of = np.repeat(blocks, groups)
        low, high = v.first[of], v.first[of + 1]
        at = v.upto[low][:, None] + self.rng.random((len(of), k)) * (v.upto[high] - v.upto[low])[:, None]
        others = (np.searchsorted(v.upto, at, side="right") - 1).clip(low[:, None], high[:, None] - 1)
        bias = t["bias"][:, 0] - self.word_offset
        laid = np.zeros((len(of) * GROUP, width + 1), np.float32)
        laid[place, :width] = query
        laid[place, width] = 1  # places that no token takes are zeros and pull nothing
        laid = laid.reshape(len(of), GROUP, width + 1)
        against = np.concatenate([t["after"][others], bias[others][:, :, None]], axis=2)
        vectors = t["after"][word]
        true, noise = _errors(np.einsum("bd,bd->b", query, vectors) + bias[word], laid @ against.transpose(0, 2, 1))
        back += (noise @ against[:, :, :width]).reshape(-1, width)[place]
        vectors *= true[:, None]
        back += vectors
        pulled = np.empty((n, 2 * width + 1), np.float32)
        np.multiply(query, true[:, None], out=pulled[:, :width])
        pulled[:, width] = true
        # What a token pulls on its own context vector comes from the two after it.
        in_text = np.empty_like(back)
        in_text[order] = back
        one, two = product(in_text, t["places"][:width].T), product(in_text, t["places"][width:].T)
        at_start = one[starts].sum(axis=0) + two[starts].sum(axis=0) + two[second].sum(axis=0)
        one[starts] = two[starts] = two[second] = 0
        pull = np.zeros((n + 2, width), np.float32)
        pull[1:-1] += one
        pull[:-2] += two
        np.take(pull[2:], order, axis=0, out=pulled[:, width + 1 :])
        pulled = _run_sums(pulled, first_word)
        for_contexts = _by_row(np.concatenate([words, ahead, [v.start]]), np.vstack([pulled[:, width + 1 :], pull[:2], at_start]))
        for_words = _by_row(
            np.concatenate([words, others.ravel()]), np.vstack([pulled[:, : width + 1], (noise.transpose(0, 2, 1) @ laid).reshape(-1, width + 1)])
        )
        self._move("places", slice(None), inner(near, back))
        for table, (rows, gradient) in (("block", for_blocks), ("after", for_words)):
            self._move(table, rows, gradient[:, :-1])
            self._move("bias" if table == "after" else "block_bias", rows, gradient[:, -1:])
        self._move("before", *for_contexts)

    def learn(self, texts: list[np.ndarray]) -> None:
        """One pass over some texts, laid end to end."""
        starts = np.cumsum([0] + [len(x) for x in texts[:-1]])
        sym = np.concatenate(texts).astype(np.int64, copy=False)
        one, two = contexts(sym, starts, self.v.start)
        for i in range(0, len(sym), self.shape.batch):
            mine = starts[np.searchsorted(starts, i) : np.searchsorted(starts, i + self.shape.batch)] - i
            self.step(sym[i : i + self.shape.batch], mine, np.array([two[i], one[i]]))

    def changes(self, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each table: the rows that moved, the gradient they saw, and their change times that."""
        for number, name in enumerate(TABLES):
            seen = (self.past[name] - np.float32(1e-3)).sum(axis=1, dtype=np.float64)
            rows = np.flatnonzero(seen > 0)
            change = (self.tables[name][rows] - model.tables[name][rows]).astype(np.float64)
            yield number, rows, seen[rows], change * seen[rows, None]


class Sums:
    """What the shards of a task change, added up: by table, the gradient each row saw and its change times that."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.seen = [np.zeros(len(model.tables[k])) for k in TABLES]
        self.change = [np.zeros(model.tables[k].shape) for k in TABLES]

    def add(self, trainer: Trainer) -> None:
        for number, rows, seen, change in trainer.changes(self.model):
            self.seen[number][rows] += seen
            self.change[number][rows] += change

    def rows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for number, (seen, change) in enumerate(zip(self.seen, self.change)):
            rows = np.flatnonzero(seen > 0)
            yield number, rows, seen[rows], change[rows]


def dealt(tokens: float, v: Vocabulary, shape: Shape) -> tuple[int, int]:
    """Tasks of a round of so many tokens, and the shards of each."""
    shards = max(1, int(tokens) // shape.shard_tokens)
    together = -(-READ * v.size // shape.shard_tokens)
    tasks = max(-(-shards // together), min(shards, TASKS))
    return tasks, -(-shards // tasks)


def train_round(train: DataFrame, model: Model, v: Vocabulary, shape: Shape, number: int) -> Model:
    """The model after each shard trained a copy on its texts; what comes back has one row for each row of the model."""
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast((model, v.bare()))
    width = shape.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model, v = shared.value
        sums, part = Sums(model), TaskContext.get().partitionId()
        for shard, texts in enumerate(_shards(batches, v, shape)):
            trainer = Trainer(model, v, shape, [number, part, shard])
            for held in texts:
                trainer.learn(held)
            sums.add(trainer)
        for kind, rows, seen, change in sums.rows():
            full = np.zeros((len(rows), width), np.float32)
            full[:, : change.shape[1]] = change
            arrays = [np.full(len(rows), kind, np.int32), rows.astype(np.int32), seen, *full.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in arrays], names)

    names = ["kind", "row", "seen", *[f"d{i}" for i in range(width)]]
    schema = ", ".join(["kind int", "row int", "seen double", *[f"d{i} float" for i in range(width)]])
    sums = train.select("symbols").mapInArrow(run, schema).groupBy("kind", "row").agg(*[F.sum(c).alias(c) for c in names[2:]])
    # Bounded by the vocabulary, which the dictionary bounds.
    with setting(spark, CLEAN_SHUFFLES, "true"):
        got = sums.toArrow()
    kind, row, seen = (got.column(c).to_numpy() for c in names[:3])
    change = np.column_stack([got.column(c).to_numpy() for c in names[3:]]) / seen[:, None] if len(seen) else np.zeros((0, width))
    tables = {}
    for i, name in enumerate(TABLES):
        tables[name] = model.tables[name].copy()
        mine = kind == i
        tables[name][row[mine]] += change[mine][:, : tables[name].shape[1]].astype(np.float32)
    shared.destroy()
    return Model(tables)


def _shards(batches: Iterator[pa.RecordBatch], v: Vocabulary, shape: Shape) -> Iterator[Iterator[list[np.ndarray]]]:
    """The texts of a task, ``CHUNK`` tokens at a time, by shard; the last of its ``task_shards`` has what is left."""

    def chunks() -> Iterator[list[np.ndarray]]:
        held, total = [], 0
        for batch in batches:
            for symbols in batch.column("symbols").to_pylist():
                held.append(np.frombuffer(symbols, v.stored))
                total += len(held[-1])
                if total >= CHUNK:
                    yield held
                    held, total = [], 0
        if held:
            yield held

    left = chunks()

    def shard(held: list[np.ndarray], last: bool) -> Iterator[list[np.ndarray]]:
        total = 0
        while held:
            yield held
            total += sum(map(len, held))
            held = None if total >= shape.shard_tokens and not last else next(left, None)

    for number in range(shape.task_shards):
        held = next(left, None)
        if held is None:
            return
        yield shard(held, number == shape.task_shards - 1)


def train_model(train: DataFrame, tokens: int, v: Vocabulary, shape: Shape) -> Model:
    """``train`` has ``part``, a number below a million dealt by hash, and ``symbols`` of each training text."""
    model = Model.fresh(v, shape.width)
    step = shape.share / shape.rounds
    tasks, each = dealt(tokens * step, v, shape)
    # The number of steps stops growing at some thousands, their size goes on.
    shape = replace(shape, batch=min(4 * shape.batch, max(shape.batch, tokens >> 12)), task_shards=each)
    for number in range(shape.rounds):
        mine = F.col("part").between(int(1e6 * step * number), int(1e6 * step * (number + 1)) - 1)
        model = train_round(train.filter(mine).coalesce(tasks), model, v, shape, number)
    return model


def lm_scores(docs: DataFrame, fold_parts: int = 10, shape: Shape = Shape(), dictionary: int = DICTIONARY) -> DataFrame:
    """Scores of all documents; those whose fold is 0 are held out of all counts and training."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select(
        "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
        (fold("doc_id", fold_parts) == 0).alias("held_out"),
    ).withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)).cast("int"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    # Every training text adds its words and one end.
    counts = cut_lineage(tallied(docs.filter(~F.col("held_out")).select("text"), _with_ends))
    ends = F.sum(F.when(F.col("word") == F.lit(bytearray(END)), F.col("n")))
    total, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), ends).first()
    common = {bytes(r["word"]): r["n"] for r in frequent(counts, dictionary).toLocalIterator()}
    if ends:
        common[END] = ends
    least = max(shape.least, shape.root * total**0.5)
    chosen = {w: n for w, n in common.items() if n >= least or w == END}
    chosen.setdefault(END, 0)

    # Tokens and distinct words of each rare symbol.
    rare_n, rare_v = _rare_totals(counts, sc.broadcast(chosen), shape)
    v = Vocabulary({w: n or SMOOTHING for w, n in chosen.items()}, rare_n)
    floor = total + SMOOTHING * (distinct + 1)
    rare_floor = rare_n + SMOOTHING * (rare_v + 1)
    order = sorted(common)
    index = {w: i for i, w in enumerate(order)}
    n = np.array([common[w] for w in order], np.float64)
    is_rare = np.array([w not in v.symbol for w in order], bool)
    rare_of = np.array([ending(w, shape.rare) if r else 0 for w, r in zip(order, is_rare.tolist())], np.int64)
    symbol = np.array([v.symbol.get(w, -1) for w in order], np.int64)
    base = np.log10((n + SMOOTHING) / floor) if len(n) else np.zeros(0)
    share = np.zeros(len(n))
    if len(n):
        symbol[is_rare] = v.rare_symbol[rare_of[is_rare]]
        share[is_rare] = np.log10((n[is_rare] + SMOOTHING) / rare_floor[rare_of[is_rare]])
    # The last place is for words that the dictionary lacks.
    symbol, base, share = (np.append(x, 0) for x in (symbol, base, share))
    given = sc.broadcast((index, symbol, base, share, v.bare()))
    end_base = float(np.log10((common.get(END, 0) + SMOOTHING) / floor))
    end_known = END in common

    def work(batch: pa.RecordBatch):
        index, symbol, base, share, v = given.value
        for low, texts in slices(batch.column("text"), CUT):
            some, k = batch.slice(low, len(texts)), len(texts)
            text, code, distinct = lower_words(texts)
            words = distinct.to_numpy(zero_copy_only=False).tolist()
            at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
            lacking = np.flatnonzero(at < 0)
            end_of = np.zeros(len(words), np.int32)
            end_of[lacking] = [ending(words[i], shape.rare) for i in lacking.tolist()]
            sym = symbol[at]
            sym[lacking] = v.rare_symbol[end_of[lacking]]
            n_words = np.bincount(text, minlength=k)
            upto = np.cumsum(n_words)
            symbols = np.insert(sym[code].astype(v.stored), upto, v.end)
            edges = np.concatenate([[0], upto + np.arange(1, k + 1)]) * symbols.itemsize
            known = (at >= 0)[code]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.binary()), some.column("row"), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), some.column("doc_id"), some.column("held_out"), some.column("part"),
                 pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(symbols)]), pa.array(n_words + 1),
                 pa.array(np.bincount(text[known], minlength=k) + int(end_known)), pa.array(np.bincount(text, base[at][code], k) + end_base), pa.array(np.bincount(text, share[at][code], k))], names)
            # Each word that the dictionary lacks, once for a text.
            pair, freq = np.unique(text[~known] * len(words) + code[~known], return_counts=True)
            of, m = pair % max(1, len(words)), len(pair)
            yield pa.RecordBatch.from_arrays(
                [distinct.take(pa.array(of)), some.column("row").take(pa.array(pair // max(1, len(words)))), pa.array(freq), pa.array(end_of[of]), pa.nulls(m, batch.column("doc_id").type), pa.nulls(m, pa.bool_()),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64())], names)

    # Rows of documents with their symbols, and rows of the words that the dictionary lacks.
    names = ["word", "row", "freq", "ending", "doc_id", "held_out", "part", "symbols", "n_tokens", "n_known", "base", "score"]
    parts = cut_lineage(map_batches(
        numbered(docs), work,
        f"word binary, row long, freq long, ending int, doc_id {kind}, held_out boolean, part int, symbols binary, n_tokens long, n_known long, base double, score double",
    ))
    read = parts.filter(F.col("symbols").isNotNull())
    train = read.filter(~F.col("held_out")).select("part", "symbols")
    model = train_model(train, total, v, shape) if total else Model.fresh(v, shape.width)
    scored = _model_scores(read.select(*SCORED, "symbols"), model, v)
    c = F.coalesce(F.col("n"), F.lit(0)) + F.lit(SMOOTHING)
    floors = F.array(*[F.lit(float(x)) for x in rare_floor])
    looked_up = parts.filter(F.col("word").isNotNull()).select("word", "row", "freq", "ending").join(counts, "word", "left").select(
        "row",
        F.lit(None).cast(kind).alias("doc_id"),
        F.lit(None).cast("boolean").alias("held_out"),
        F.lit(None).cast("long").alias("n_tokens"),
        F.when(F.col("n").isNotNull(), F.col("freq")).otherwise(0).alias("n_known"),
        (F.col("freq") * F.log10(c / F.lit(float(floor)))).alias("base"),
        (F.col("freq") * F.log10(c / F.get(floors, F.col("ending")))).alias("score"),
    )
    return scored.union(looked_up).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("row")


#: What is known of a document before the model's own part is added to its score.
SCORED = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]


def _model_scores(read: DataFrame, model: Model, v: Vocabulary) -> DataFrame:
    """Adds the model's log-probabilities of the ``symbols`` to ``score``."""
    given = read.sparkSession.sparkContext.broadcast((model, v.bare()))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, v = given.value
        texts = [np.frombuffer(x, v.stored) for x in batch.column("symbols").to_pylist()]
        sums: list[float] = []
        while len(sums) < len(texts):
            low, total = len(sums), 0
            high = low
            while high < len(texts) and total < CHUNK:
                total += len(texts[high])
                high += 1
            starts = np.cumsum([0] + [len(x) for x in texts[low : high - 1]])
            sym = np.concatenate(texts[low:high]).astype(np.int64)
            one, two = contexts(sym, starts, v.start)
            # A very long text goes through in pieces, its contexts known.
            log = [model.log_probability(v, one[i : i + CHUNK], two[i : i + CHUNK], sym[i : i + CHUNK]) for i in range(0, len(sym), CHUNK)]
            sums += (np.add.reduceat(np.concatenate(log).astype(np.float64), starts) / np.log(10)).tolist()
        score = pa.array(np.array(sums) + batch.column("score").to_numpy(zero_copy_only=False))
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in SCORED[:-1]], score], SCORED)

    return map_batches(read, work, read.select(*SCORED).schema)


def lower_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The lower-cased words of all texts in order: the text of each, its number, and the distinct words by number."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    words = cut.flatten().cast(pa.binary()).dictionary_encode()
    text = np.repeat(np.arange(len(texts)), pc.fill_null(cut.value_lengths(), 0).to_numpy(zero_copy_only=False))
    code, distinct = words.indices.to_numpy(zero_copy_only=False), words.dictionary
    # White space at either side of a text leaves an empty piece.
    empty = pc.index(distinct, pa.scalar(b"", pa.binary())).as_py()
    if empty >= 0:
        there = code != empty
        text, code = text[there], code[there]
    return text, code, distinct


def _with_ends(texts: pa.Array) -> Iterator[dict[bytes, int]]:
    for _, some in slices(texts, CUT):
        _, code, distinct = lower_words(some)
        n = np.bincount(code, minlength=len(distinct))
        yield {w: c for w, c in zip(distinct.to_numpy(zero_copy_only=False).tolist(), n.tolist()) if c} | {END: len(some)}


def _rare_totals(counts: DataFrame, top, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, v = np.zeros(shape.rare, np.int64), np.zeros(shape.rare, np.int64)
        for w, c in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            if w != END and w not in top.value:
                e = ending(w, shape.rare)
                n[e] += c
                v[e] += 1
        return pa.RecordBatch.from_arrays([pa.array(np.arange(shape.rare)), pa.array(n), pa.array(v)], ["e", "n", "v"])

    n, v = np.zeros(shape.rare), np.zeros(shape.rare)
    for r in map_batches(counts, work, "e long, n long, v long").groupBy("e").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n[r["e"]], v[r["e"]] = r["n"], r["v"]
    return n, v
