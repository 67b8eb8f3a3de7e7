"""Token counts of documents without token ids.

Each distinct pre-token is tokenised once for the whole corpus; the piece counts are joined to the
pre-token frequencies of each document and summed. Pre-tokens are runs between ASCII white space,
which the tokenizer's normaliser and pre-tokenizer never join, cut further at the borders between
letters, digits and other signs where the text is simple enough to know that the tokenizer cuts
there too. Runs that hold a special token's string stay whole.

Null text has no bytes and no tokens. Repeated documents each get their row, null ids too. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weirgate.llm.common import map_batches, numbered
from weirgate.llm.frequencies import DICTIONARY, frequent, word_counts
from weirgate.session import cut_lineage

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Latin letters below U+0250 whose normal form and lower case are one letter; anything else keeps its runs whole.
_SIMPLE = re.compile("[\t-\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*")
_PIECE = re.compile(r"'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])|[^\W_]+|(?:[^\w\s]|_)+")
_SPACES = re.compile(r"[^\x20\x09-\x0D]+")
_TOKENIZERS: dict[str, tuple[Tokenizer, list[str]]] = {}


def load(name: str) -> tuple[Tokenizer, list[str]]:
    """The tokenizer and its special strings, once per worker."""
    if name not in _TOKENIZERS:
        t = Tokenizer.from_file(public_tokenizers.path(name))
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[name] = t, [x.content for x in t.get_added_tokens_decoder().values()]
    return _TOKENIZERS[name]


def pretokens(text: str, special: list[str]) -> Counter:
    """Frequencies of the pre-tokens of a text."""
    if _SIMPLE.fullmatch(text) and not any(s in text for s in special):
        return Counter(_PIECE.findall(text))
    return Counter(_SPACES.findall(text))


def count_pieces(words: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``word`` and ``pieces`` of each distinct word."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ws = batch.column("word").to_pylist()
        out = [len(e.ids) for e in load(tokenizer)[0].encode_batch_fast(ws, add_special_tokens=False)]
        return pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(out, pa.int64())], ["word", "n", "pieces"])

    return map_batches(words, work, "word string, n long, pieces long")


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, dictionary: int = DICTIONARY) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def words(text: str) -> Counter:
        return pretokens(text, load(tokenizer)[1])

    counts = word_counts(docs.select("text"), words)
    pieces = cut_lineage(count_pieces(counts, tokenizer))
    common = spark.sparkContext.broadcast({r["word"]: r["pieces"] for r in frequent(pieces, dictionary).toLocalIterator()})

    def split(batch: pa.RecordBatch):
        special, known = load(tokenizer)[1], common.value
        rows, ids, texts = batch.column("row").to_pylist(), batch.column("doc_id"), batch.column("text").to_pylist()
        n_bytes, settled = [], []
        word, row, freq = [], [], []
        for r, text in zip(rows, texts):
            text = text or ""
            n_bytes.append(len(text.encode()))
            total = 0
            for w, n in pretokens(text, special).items():
                p = known.get(w)
                if p is None:
                    word.append(w)
                    row.append(r)
                    freq.append(n)
                else:
                    total += p * n
            settled.append(total)
        # A document's own row has a word that no text holds, so it joins with nothing.
        yield pa.RecordBatch.from_arrays(
            [pa.array([f" {r}" for r in rows]), batch.column("row"), pa.nulls(len(rows), pa.int64()), ids, pa.array(n_bytes, pa.int64()), pa.array(settled, pa.int64())], names
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(word, pa.string()), pa.array(row, pa.int64()), pa.array(freq, pa.int64()), pa.nulls(len(word), ids.type), pa.nulls(len(word), pa.int64()), pa.nulls(len(word), pa.int64())], names
        )

    names = ["word", "row", "freq", "doc_id", "n_bytes", "settled"]
    parts = map_batches(numbered(docs), split, f"word string, row long, freq long, doc_id {kind}, n_bytes long, settled long")
    joined = parts.join(pieces.select("word", "pieces"), "word", "left")
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            (F.coalesce(F.sum(F.col("freq") * F.col("pieces")), F.lit(0)) + F.max("settled")).alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
