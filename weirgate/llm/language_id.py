"""Language identification with segmentation-marginalised unigrams.

A fixed public vocabulary of pieces gives the units; each language has its own piece
probabilities. The probability of a word in a language is the sum over all its segmentations into
pieces, which the forward algorithm gives, and a text's is the product over its words times the
language's share. Texts are lower-cased and cut into words of letters (Unicode category L). All pieces
of letters count, whatever their length, and words are never cut: short ones go through the forward
algorithm side by side, long ones each with a rolling window that is rescaled as it goes.

The model is fitted by expectation-maximisation on a bounded sample: of each language at most about
``per_language`` texts of the training fold, taken by a hash of their id, and of these the words of up
to ``SHORT`` letters. Everything else reads all documents whole.

A null text, or one without a letter, is ``und`` with score 0. Languages are the non-null values of
``lang`` in the training fold; if there are none, all texts are ``und``. Ties go to the first
language in code-point order. A null id counts as the empty text when folds are made. Repeated
documents each get their row; an empty table gives no rows. Other columns are ignored or, in
``keep_identified``, kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import fold, held, let_go, map_batches
from weirgate.session import CLEAN_SHUFFLES, cut_lineage, setting

VOCABULARY = "piece_bpe_32k.model"
PER_LANGUAGE = 500
#: Probability of a character that no piece holds, and the least one of a piece.
UNKNOWN = 1e-7
#: Remembered words per worker, and the longest of them.
REMEMBERED = 200_000
#: Words of more letters go through the forward algorithm alone; the model is fitted on the others.
SHORT = 40
WORDS = re.compile(r"[^\W\d_]+")
MARK = "▁"


def letter_words(text: str) -> list[str]:
    """Lower-case runs of letters; numbers that count as word characters, such as ``½``, end a run."""
    words = WORDS.findall(text.lower())
    if text.isascii():
        return words
    return [p for w in words for p in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


class Pieces:
    """The vocabulary as a hash table over strings of code points."""

    def __init__(self, name: str = VOCABULARY) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.pieces = sorted(p for p in pieces if p and (p.lstrip(MARK).isalpha() or p == MARK))
        self.longest = max(map(len, self.pieces))
        rng = np.random.default_rng(11)
        self.odd = rng.integers(1, 1 << 62, self.longest + 1, dtype=np.uint64) | np.uint64(1)
        keys = np.zeros(len(self.pieces), np.uint64)
        for at, chars in grouped(self.pieces, mark=""):
            keys[at] = self.extend(chars)[-1]
        self.bits = 20
        order = np.argsort(self._slot(keys), kind="stable")
        self.keys, self.ids = keys[order], order
        slots = self._slot(self.keys)
        self.first = np.searchsorted(slots, np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.probes = int(np.diff(self.first).max())

    def extend(self, chars: np.ndarray) -> list[np.ndarray]:
        """Keys of the prefixes of each row: sums of code points mixed by their place."""
        out, key = [], np.zeros(len(chars), np.uint64)
        for j in range(chars.shape[1]):
            c = chars[:, j].astype(np.uint64) * self.odd[j]
            key = key + (c ^ (c >> np.uint64(29))) * self.odd[-1]
            out.append(key)
        return out

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(31))) * self.odd[0] >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece number of each key, or -1."""
        at = self.first[self._slot(keys)]
        out = np.full(len(keys), -1, np.int64)
        for k in range(self.probes):
            i = np.minimum(at + k, len(self.keys) - 1)
            out = np.where(self.keys[i] == keys, self.ids[i], out)
        return out


def grouped(words: list[str], mark: str = MARK):
    """(places in ``words``, code points) of the marked words of each length."""
    marked = [mark + w for w in words]
    lengths = np.array([len(w) for w in marked])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        text = "".join([marked[i] for i in at])
        yield at, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(at), n)


def found(pieces: Pieces, chars: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """Piece numbers by (start, end) of the substrings of equally long words."""
    n, out = chars.shape[1], {}
    for start in range(n):
        keys = pieces.extend(chars[:, start : start + pieces.longest])
        for j, k in enumerate(keys):
            out[start, start + j + 1] = pieces.find(k)
    return out


def forward(spans: dict, probability: np.ndarray, rows: int, n: int) -> np.ndarray:
    """Sums over all segmentations of the first j characters, by j, word and language."""
    out = np.zeros((n + 1, rows, probability.shape[1]))
    out[0] = 1.0
    for end in range(1, n + 1):
        for start in range(end):
            got = spans.get((start, end))
            if got is None:
                continue
            p = probability[got]
            if end - start == 1:
                p = np.where((got < 0)[:, None], UNKNOWN, p)
            out[end] += out[start] * p
    return out


#: Starts of a long word whose pieces are looked up together.
_WINDOW = 1 << 14


def long_forward(pieces: Pieces, word: str, probability: np.ndarray) -> np.ndarray:
    """Log of the sum over all segmentations of one word of any length, by language.

    The last ``longest`` sums are held, divided by the largest of them at every step.
    """
    chars = np.frombuffer((MARK + word).encode("utf-32-le"), np.uint32)
    n, longest = len(chars), pieces.longest
    recent = np.zeros((longest, probability.shape[1]))  # sums of the first j characters, j mod longest
    recent[0] = 1.0
    scale = np.zeros(probability.shape[1])
    ids = np.zeros((0, 0), np.int64)
    for end in range(1, n + 1):
        # Pieces by (end, length) for a window of ends, from the reversed lengths of their starts.
        row = (end - 1) % _WINDOW
        if row == 0:
            ends = np.arange(end, min(n, end + _WINDOW - 1) + 1)
            ids = np.full((len(ends), longest), -1, np.int64)
            low = max(0, end - longest)
            view = chars[low : ends[-1]]
            key = np.zeros(len(view), np.uint64)
            for size in range(1, min(longest, len(view)) + 1):
                c = np.zeros(len(view), np.uint64)
                c[: len(view) - size + 1] = view[size - 1 :].astype(np.uint64) * pieces.odd[size - 1]
                key = key + (c ^ (c >> np.uint64(29))) * pieces.odd[-1]
                starts = ends - size - low
                ok = ends >= size
                ids[ok, size - 1] = pieces.find(key[starts[ok]])
        sizes = np.arange(1, min(longest, end) + 1)
        got = ids[row, : len(sizes)]
        p = probability[got]
        if got[0] < 0:
            p[0] = UNKNOWN
        total = (recent[(end - sizes) % longest] * p).sum(axis=0)
        recent[end % longest] = total
        top = recent.max(axis=0)
        recent /= top
        scale += np.log(top)
    return np.log(np.maximum(recent[n % longest], 1e-300)) + scale


def expected(spans: dict, probability: np.ndarray, n: int, weights: np.ndarray, into: np.ndarray) -> None:
    """Adds the expected piece counts of words with ``weights`` (word, language) to ``into``."""
    rows = len(weights)
    ahead = forward(spans, probability, rows, n)
    back = np.zeros_like(ahead)
    back[n] = 1.0
    for start in range(n - 1, -1, -1):
        for end in range(start + 1, n + 1):
            got = spans.get((start, end))
            if got is None:
                break
            p = probability[got]
            if end - start == 1:
                p = np.where((got < 0)[:, None], UNKNOWN, p)
            back[start] += p * back[end]
    for (start, end), got in spans.items():
        has = got >= 0
        if has.any():
            share = weights[has] * ahead[start][has] * probability[got[has]] * back[end][has] / ahead[n][has]
            np.add.at(into, got[has], share)


@dataclass
class Languages:
    names: list[str]
    prior: np.ndarray
    probability: np.ndarray
    vocabulary: str


def _smoothed(counts: np.ndarray) -> np.ndarray:
    """Probabilities by language; a last row of zeros stands for strings that are no piece."""
    p = (counts + 0.05) / (counts + 0.05).sum(axis=0)
    return np.vstack([p, np.zeros(p.shape[1])])


def _expectation(counts: DataFrame, probability: np.ndarray | None, languages: int, vocabulary: str) -> np.ndarray:
    """Expected piece counts by language over all words; without ``probability`` shorter pieces start likelier.

    The driver gets one number for each piece and language, never words.
    """
    spark = counts.sparkSession
    shared = spark.sparkContext.broadcast(probability)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(but="pieces")
        yield _expected_rows(batches, shared.value, languages, vocabulary)

    sums = counts.mapInArrow(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
    with setting(spark, CLEAN_SHUFFLES, "true"):
        got = sums.toArrow()
    shared.destroy()
    piece, lang, n = (got.column(c).to_numpy() for c in ("piece", "lang", "n"))
    # Each task names the number of pieces by a row of its own.
    into = np.zeros(((int(piece.max()) if len(piece) else len(Pieces(vocabulary).pieces)) + 1, languages))
    into[piece, lang] = n
    return into[:-1]


def _expected_rows(batches: Iterator[pa.RecordBatch], probability: np.ndarray | None, languages: int, vocabulary: str) -> pa.RecordBatch:
    pieces = held("pieces", vocabulary, lambda: Pieces(vocabulary))
    if probability is None:
        probability = _smoothed(np.array([[2.0 ** -len(p)] * languages for p in pieces.pieces]))
    into = np.zeros((len(pieces.pieces), languages))
    for batch in batches:
        weights = np.asarray(batch.column("weights").flatten()).reshape(-1, languages)
        for at, chars in grouped(batch.column("word").to_pylist()) if batch.num_rows else ():
            expected(found(pieces, chars), probability, chars.shape[1], weights[at], into)
    piece, lang = np.nonzero(into)
    rows = [np.append(piece, len(into)).astype(np.int32), np.append(lang, 0).astype(np.int32), np.append(into[piece, lang], 0.0)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["piece", "lang", "n"])


def fit(docs: DataFrame, train: F.Column, per_language: int = PER_LANGUAGE, rounds: int = 3, vocabulary: str = VOCABULARY) -> Languages:
    """Piece probabilities from the word counts of a bounded sample of the training rows, fitted in tasks."""
    known = docs.filter(train & F.col("lang").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Languages([], np.zeros(0), np.zeros((1, 0)), vocabulary)
    rate = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, per_language / sizes[n])))])
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.element_at(rate, F.col("lang")) * 1_000_000

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            total.update((lang, w) for w in letter_words(text or "") if len(w) <= SHORT)
        langs, words = zip(*total) if total else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(total.values(), pa.int64())], ["lang", "word", "n"])

    spark = docs.sparkSession
    by_lang = [F.sum(F.when(F.col("lang") == F.lit(x), F.col("n")).otherwise(F.lit(0))).cast("double") for x in names]
    rows = map_batches(known.filter(drawn), work, "lang string, word string, n long").groupBy("word").agg(F.array(*by_lang).alias("weights"))
    # As many parts as there are cores: each round's sums are worked out where the words are.
    counts = cut_lineage(rows.repartition(spark.sparkContext.defaultParallelism, "word"))
    probability = None
    for _ in range(rounds):
        into = _expectation(counts, probability, len(names), vocabulary)
        probability = _smoothed(into)
    prior = np.array([sizes[n] for n in names], float)
    return Languages(names, np.log(prior / prior.sum()), probability, vocabulary)


class Scorer:
    """Log-probabilities of words by language, remembered while they fit."""

    def __init__(self, model: Languages) -> None:
        self.model, self.pieces, self.index = model, Pieces(model.vocabulary), {}
        self.letters = 0
        self.table = np.zeros((REMEMBERED, len(model.names)))

    def learn(self, words: list[str]) -> None:
        out = np.zeros((len(words), len(self.model.names)))
        short = np.array([i for i, w in enumerate(words) if len(w) <= SHORT], np.int64)
        for at, chars in grouped([words[i] for i in short]) if len(short) else ():
            for i in range(0, len(at), 4096):
                some = chars[i : i + 4096]
                p = forward(found(self.pieces, some), self.model.probability, *some.shape)[-1]
                out[short[at[i : i + 4096]]] = np.log(np.maximum(p, 1e-300))
        for i, w in enumerate(words):
            if len(w) > SHORT:
                out[i] = long_forward(self.pieces, w, self.model.probability)
        base = len(self.index)
        self.table[base : base + len(words)] = out
        self.index.update(zip(words, range(base, base + len(words))))
        self.letters += sum(map(len, words))

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, index = self.model.names, self.index
        bags = [Counter(letter_words(t)) if t else Counter() for t in texts]
        new = list({w for b in bags for w in b if w not in index})
        if len(index) + len(new) > REMEMBERED or self.letters > 16 * REMEMBERED:
            index.clear()
            self.letters = 0
            new = list({w for b in bags for w in b})
        if len(new) > len(self.table):
            self.table = np.zeros((len(new), len(names)))
        if new and names:
            self.learn(new)
        said, score = [], []
        for b in bags:
            if not b or not names:
                said.append("und")
                score.append(0.0)
                continue
            at = np.fromiter(map(index.__getitem__, b), np.int64, len(b))
            z = np.fromiter(b.values(), float, len(b)) @ self.table[at] + self.model.prior
            best = int(z.argmax())
            said.append(names[best])
            score.append(float(1 / np.exp(np.minimum(z - z[best], 0)).sum()))
        return said, score


def scorer(model: Languages) -> Scorer:
    """One per worker and model; the scorer holds the model, so its number is not given anew."""
    return held("language", id(model), lambda: Scorer(model))


def _predicted(shared, texts: pa.Array) -> tuple[list[str], list[float]]:
    said, score, texts = [], [], texts.to_pylist()
    for i in range(0, len(texts), 500):
        a, b = scorer(shared.value).texts(texts[i : i + 500])
        said += a
        score += b
    return said, score


def identify(docs: DataFrame, fold_parts: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (posterior of that language) of every document."""
    out_of = fold("doc_id", fold_parts) == held_out
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, ~out_of, per_language))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        said, score = _predicted(shared, batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(said, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), out_of.alias("held_out"))
    return map_batches(rows, work, f"doc_id {kind}, held_out boolean, lang_pred string, score double", keeps="language")


def keep_identified(docs: DataFrame, least: float = 0.5, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents whose language is found with a posterior of at least ``least``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, F.lit(True), per_language))
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        said, score = _predicted(shared, batch.column(at))
        return batch.filter(pa.array([a != "und" and b >= least for a, b in zip(said, score)], pa.bool_()))

    return map_batches(docs, work, docs.schema, keeps="language")
