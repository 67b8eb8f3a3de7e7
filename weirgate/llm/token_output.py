"""Token ids as ORC files in document order, and their way back.

ORC stores the id lists with its integer run-length encoding, keeps row indexes every
``row_index_stride`` rows and a Bloom filter on ``doc_id``, so readers take stripes in parallel and
skip those that cannot hold a wanted document.

Null text encodes as the empty text (the end id alone). Null ids come first. Rows with the same id
are ordered by a hash of their text; equal rows are interchangeable. An empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weirgate.llm.common import held, map_batches, slices
from weirgate.session import cut_lineage, scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Bytes of remembered words per worker, in two halves: the older one goes when the newer one is full.
REMEMBERED = 160 << 20
#: Bytes that an entry takes besides its characters and ids.
ENTRY = 160
#: Words of fewer characters are remembered.
LONGEST = 64
#: New words that are remembered at once.
AT_ONCE = 500
#: Bytes of texts that are encoded together.
CUT = 4 << 20
#: Pre-tokens in a string for the model, and what stands between them: a byte that UTF-8 never has.
TOGETHER = 200
APART = b"\xff"
# White space among the characters of SIMPLE.
_SPACE = r"\t-\r "
#: The first word of a text that is cut at spaces and before line feeds.
FIRST = re.compile(r"[^ \n]*")
#: Before a word that nothing stands before; a character outside SIMPLE.
BARE = "\x1c"
#: Texts of these characters only (Latin, without odd white space) are cut here; others go whole.
SIMPLE = re.compile("[\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u024f]*")


def _class(kind: str) -> str:
    """The characters of ``kind`` among those of SIMPLE, listed: a listed class is matched faster than a described one."""
    found = [c for c in map(chr, range(0x250)) if SIMPLE.fullmatch(c) and re.fullmatch(kind, c)]
    return "[" + "".join(f"\\u{ord(c):04x}" for c in found) + "]"


#: The pre-tokens of the tokenizer, for texts of those characters; words come first, as most are.
PIECE = re.compile(
    rf" ?{_class(r'[^\W\d_²³¹¼½¾]')}+|'(?:s|t|re|ve|m|ll|d)| ?{_class(r'[\d²³¹¼½¾]')}+"
    rf"| ?{_class(rf'[^\w{_SPACE}]|_')}+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


def _byte_signs() -> dict[int, str]:
    """The sign that a byte-level model has for each byte: printable ones stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SIGNS = _byte_signs()
_WIDE = np.array([ord(_SIGNS[b]) for b in range(256)], "<u2")


def _bytes_of(kind: str) -> np.ndarray:
    """Which bytes are an ASCII character of ``kind``."""
    return np.array([b < 128 and bool(re.fullmatch(kind, chr(b))) for b in range(256)])


_BLANK, _ALNUM, _SIGN = (_bytes_of(kind) for kind in (f"[{_SPACE}]", "[A-Za-z0-9]", r"[!-/:-@\[-`{-~]"))


class _Known(dict):
    """Ids of words by their place in ``words``. What is unknown is handed to ``tokenize`` and worked out by ``settled``."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        super().__init__()
        self.model = tokenizer.model
        self.bare = Tokenizer(self.model)
        self.apart = self.bare.token_to_id(_SIGNS[APART[0]])
        self.waiting: list[str] = []
        self.tokenize = self.waiting.append
        self.older: dict[str, bytes] = {}
        self.bytes = 0

    def settled(self) -> list[bytes]:
        """Ids of the pre-tokens handed in. The model gets many as one string, with a byte between them that no text
        has and no merge takes, so none reaches over it; were it merged after all, each goes alone."""
        pieces, out = self.waiting.copy(), []
        self.waiting.clear()
        for k in range(0, len(pieces), 100 * TOGETHER):
            some = pieces[k : k + 100 * TOGETHER]
            lines, ids = [_signs(some[i : i + TOGETHER]) for i in range(0, len(some), TOGETHER)], []
            for line in self.bare.encode_batch_fast(lines, add_special_tokens=False):
                ids += line.ids
                ids.append(-1 if self.apart is None else self.apart)
            ids = np.array(ids, np.int64)
            ends = np.flatnonzero(ids == self.apart)
            if len(ends) == len(some):
                raw, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
                out += [raw[a:b] for a, b in zip([0, *[e + 4 for e in ends]], ends)]
            else:
                out += [array("I", [t.id for t in self.model.tokenize(_signs([p]))]).tobytes() for p in some]
        return out

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words that stand behind a space or begin with a line feed or ``BARE``; a word may be several pre-tokens."""
        if self.bytes > REMEMBERED // 2:
            self.age()
        found = list(map(self.get, words))
        at = [i for i, ids in enumerate(found) if ids is None]
        new = [words[i] for i in at]
        ids = list(map(self.older.get, new))
        unknown, many, tokenize = [i for i, x in enumerate(ids) if x is None], [], self.tokenize
        for i in unknown:
            word = new[i]
            if word.isalpha():
                tokenize(" " + word)
                many.append(1)
            else:
                pieces = PIECE.findall(word[1:] if word[:1] == BARE else word if word[:1] == "\n" else " " + word)
                many.append(len(pieces))
                for piece in pieces:
                    tokenize(piece)
        settled = iter(self.settled())
        for i, n in zip(unknown, many):
            ids[i] = next(settled) if n == 1 else b"".join(islice(settled, n))
        for i, x in zip(at, ids):
            found[i] = x
        for k in range(0, len(new), AT_ONCE):
            some = {w: x for w, x in zip(new[k : k + AT_ONCE], ids[k : k + AT_ONCE]) if len(w) < LONGEST}
            self.update(some)
            self.bytes += sum(map(len, some)) + sum(map(len, some.values())) + ENTRY * len(some)
            if self.bytes > REMEMBERED // 2:
                self.age()
        return found

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are cut by the pattern."""
        cut = [PIECE.findall(t) for t in texts]
        pieces = list(dict.fromkeys(chain.from_iterable(cut)))
        ids = dict(zip(pieces, self.words([p[1:] if p[0] == " " and p[1:2] != "\n" else BARE + p for p in pieces])))
        return [b"".join(map(ids.__getitem__, c)) for c in cut]

    def age(self) -> None:
        """What was not asked for since the last time is forgotten; frequent words stay."""
        self.older = dict(self)
        self.clear()
        self.bytes = 0


def _signs(pieces: list[str]) -> str:
    """Pre-tokens in the signs of the model, ``APART`` between them."""
    return _WIDE[np.frombuffer(APART.join(map(str.encode, pieces)), np.uint8)].tobytes().decode("utf-16-le")


class Encoder:
    """Encodes texts with a byte-level tokenizer; a word is encoded once while remembered."""

    def __init__(self, name: str = TOKENIZER) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Known(self.tokenizer)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[bytes] = []
        for _, some in slices(pa.array(texts, pa.string()), CUT):
            size, values = self.lists(some)
            out += [x.astype("<u4").tobytes() for x in np.split(values, np.cumsum(size)[:-1])]
        return out

    def lists(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, and all ids in order.

        Texts are cut at spaces and before line feeds. A pre-token goes on over such a place only if white space
        stands on both sides of it; those texts are cut by the pattern. Each distinct word is looked up once,
        without the sign behind it.
        """
        strings = texts.to_pylist()
        plain = np.array([bool(SIMPLE.fullmatch(t)) and not any(s in t for s in self.special) for t in strings])
        cut = texts if plain.all() else pc.if_else(pa.array(plain), texts, "")
        size, code, words, low, high, data, odd = _cut(cut)
        if odd.any():
            size, code, words, low, high, data, _ = _cut(pc.if_else(pa.array(odd), "", cut))
        first = np.cumsum(size) - size
        # A sign behind a letter or digit and before a space is a pre-token.
        signed = (high - low > 1) & _SIGN[data[high - 1]] & _ALNUM[data[high - 2]]
        sign, which = np.unique(data[high[signed] - 1], return_inverse=True)
        values, length = self._words(data, low, high, signed, [chr(b) for b in sign], which)
        # The first word has no space before it; a text that is not cut like this is its first and only word.
        by_pattern = iter(self.known.texts([t if o else FIRST.match(t)[0] for t, o, p in zip(strings, odd, plain) if p]))
        firsts = [next(by_pattern) if p else self.whole([t])[0] for t, p in zip(strings, plain)]
        code[first] = np.arange(len(words), len(words) + len(texts))
        more, lengths = _joined(firsts)
        values, length = _picked(np.concatenate([values, more]), np.concatenate([length, lengths]), code)
        return np.add.reduceat(length, first), values

    def _words(self, data: np.ndarray, low: np.ndarray, high: np.ndarray, signed: np.ndarray, sign: list[str], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these bytes, laid end to end, and how many each has."""
        kept = np.ones(len(data), bool)
        kept[high[signed] - 1] = kept[0] = kept[-1] = False
        ends = np.concatenate([[0], np.cumsum(high - low - signed)]).astype(np.int32)
        bare = pa.StringArray.from_buffers(len(low), pa.py_buffer(ends), pa.py_buffer(data[kept])).dictionary_encode()
        ids = self.known.words(bare.dictionary.to_numpy(zero_copy_only=False).tolist())
        behind = np.full(len(low), len(ids))
        behind[signed] += 1 + which
        values, length = _joined([*ids, b"", *self.known.texts(sign)])
        values, length = _picked(values, length, np.column_stack([bare.indices.to_numpy(), behind]).ravel())
        return values, length[::2] + length[1::2]


def _cut(texts: pa.Array) -> tuple:
    """Texts in words: how many each has, the number of each word among the distinct ones, these with their first byte
    and the one after the last in the bytes, and which texts have white space on both sides of a cut."""
    cut = pc.replace_substring(texts, "\n", " \n")
    for _ in range(2):  # line feeds in a row stay together
        cut = pc.replace_substring(cut, "\n \n", "\n\n")
    cut = pc.split_pattern(cut, " ")
    size = cut.value_lengths().to_numpy().astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    at = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
    # A space stands before and behind all bytes: an empty word is seen as blank.
    low, high = at[:-1] + 1, at[1:] + 1
    data = np.concatenate([[32], np.frombuffer(words.buffers()[2] or b"", np.uint8)[: at[-1]], [32]]).astype(np.uint8)
    opens, closes = _BLANK[data[low]] | (low == high), _BLANK[data[high - 1]] | (low == high)
    odd = np.zeros(len(texts), bool)
    if opens.any():
        first = np.cumsum(size) - size
        meets = np.concatenate([[False], opens[code[1:]] & closes[code[:-1]]])
        meets[first] = False
        odd = np.logical_or.reduceat(meets, first)
    return size, code, words, low, high, data, odd


def _joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), "<u4").astype(np.int32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def _picked(values: np.ndarray, length: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of values laid end to end, those numbered ``code``, and their lengths."""
    n, begin = length[code], (np.cumsum(length) - length)[code]
    at = np.repeat(begin - (np.cumsum(n) - n), n)
    at += np.arange(len(at))
    return values[at], n


def encoder(name: str) -> Encoder:
    """One per worker process."""
    return held("encoder", name, lambda: Encoder(name))


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>, the end id last), in the order of the rows."""

    def work(batch: pa.RecordBatch):
        for low, texts in slices(pc.fill_null(batch.column("text"), ""), CUT):
            size, values = encoder(tokenizer).lists(texts)
            upto = np.cumsum(size)
            ends = np.concatenate([[0], upto + np.arange(1, len(size) + 1)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.insert(values, upto, end_id)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, len(texts)), lists], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")), work, f"doc_id {kind}, ids array<int>", keeps="encoder")


def write_orc(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    stripe_bytes: int = 64 << 20,
    row_index_stride: int = 1000,
) -> str:
    """Write the ids of all documents below ``path`` in ascending order of ``doc_id``.

    One range shuffle on (doc_id, text hash, row number): rows equal in id and text do not pile up in
    one task either.
    Columns: ``part`` (number of the range), ``seq`` (ascending within it), ``doc_id``, ``ids``.
    """
    ordered = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie", "row")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "row")
    )
    (
        encode(ordered, tokenizer, end_id)
        .select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"), "doc_id", "ids")
        .write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", row_index_stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )
    return path


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of each document.

    Starts are running sums within a range plus the sum of the ranges before it, so no task sees
    more than the narrow rows of one range.
    """
    stored = spark.read.orc(path)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("ids")
        values, ends = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        counts = pa.array(np.diff(ends).astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("seq"), batch.column("doc_id"), counts, pa.array(crc, pa.int64())],
            ["part", "seq", "doc_id", "n_tokens", "ids_crc32"],
        )

    kind = stored.schema["doc_id"].dataType.simpleString()
    rows = cut_lineage(map_batches(stored, work, f"part int, seq long, doc_id {kind}, n_tokens long, ids_crc32 long"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    return (
        rows.withColumn("upto", F.sum("n_tokens").over(inside))
        .join(before, "part")
        .select("doc_id", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_output(docs: DataFrame, path: str | None = None, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write, then read back. Without ``path`` the files go below the session's shared folder."""
    spark = docs.sparkSession
    return read_index(spark, write_orc(docs, path or scratch_path(spark, "tokens"), tokenizer, end_id))
