"""Token output, token counts and the language model."""

from __future__ import annotations

import itertools
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from odd import frame, odd_rows, text_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weirgate.llm import language_model as lm
from weirgate.llm import token_output as token_files
from weirgate.llm.common import slices
from weirgate.llm.token_counts import load, pretokens, token_counts
from weirgate.llm.token_output import Encoder, encode, token_output, write_orc

SIGNS = "ab'sSt reRE1 2²½_-. \n\t\r\x0b'dllé Àÿŉǅɏªºµ­\x85\xa0\x1c 中文́İ　"


def odd_texts(n: int):
    rng = random.Random(3)
    for k in range(n):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 14)))
        yield f"{text}<|endoftext|>{text}" if k % 9 == 0 else text


def test_encoder_equals_the_library():
    e = Encoder()
    texts = list(odd_texts(4000))
    assert e.ids(texts) == [array("I", x.ids).tobytes() for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_rare_words_are_remembered_within_the_bound(monkeypatch):
    e, calls = Encoder(), []
    tokenize = e.known.tokenize
    e.known.tokenize = lambda piece: calls.append(piece) or tokenize(piece)
    texts = [" ".join(f"{k:x}".translate({i + 48: 103 + i for i in range(10)}) for k in range(i, i + 500)) for i in range(16**4, 16**4 + 200_000, 500)]
    e.ids(texts)
    once = len(calls)
    e.ids(texts)
    assert once > 190_000 and len(calls) == once
    monkeypatch.setattr(token_files, "REMEMBERED", 2000 * token_files.ENTRY)
    e.ids(texts[:20])
    assert len(e.known) + len(e.known.older) <= 2000 + 2 * 500


def test_distinct_words_are_looked_up_once_and_encoded_together(monkeypatch):
    """Texts are cut at spaces and before line feeds, signs come off the words before them; the pattern gets what is odd."""
    e, cut, lines = Encoder(), [], []
    pattern, bare = token_files.PIECE, e.known.bare

    class Pattern:
        def findall(self, text):
            cut.append(text)
            return pattern.findall(text)

    class Bare:
        def encode_batch_fast(self, texts, **k):
            lines.extend(texts)
            return bare.encode_batch_fast(texts, **k)

    monkeypatch.setattr(token_files, "PIECE", Pattern())
    e.known.bare = Bare()
    odd = ["The heon, of nd. é²  à\tb it's\n", " a ", "  \n x", "\n", "\na", "a \nb\n c", "a\n\nb \n", "", " ", "a \n  b", "中 a, b", " <|endoftext|>"]
    odd += ["a\r\n\r\nb\n \n\n\n c\n\n", "\n\nx \n\n y", "x_ y__ 12, ½! (z) 'd 'tis \n", "a'\n's 's", "\x00 a\x1c b\x00", "é, à. ÿ"]
    texts = odd * 100 + ["one two, three.\nFour five.\n\nsix\n\n\nseven\n"] * 2000 + [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100]} end" for k in range(1000)]
    want = [array("I", x.ids).tobytes() for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert e.ids(texts) == want
    assert not any(t.startswith("one two") or t in (" two", " two,") for t in cut) and len(lines) < 40
    # A sign that merges or is unknown keeps nothing apart: each pre-token then goes alone.
    e.known.clear()
    e.known.apart = None
    assert e.ids(texts) == want
    for most in (1, 50, 1 << 20):
        monkeypatch.setattr(token_files, "CUT", most)
        assert e.ids(texts[:40]) == want[:40]


def test_pretokens_add_up_to_the_library():
    tokenizer, special = load("word_bpe_49k.json")
    for text in odd_texts(4000):
        parts = sum(n * len(tokenizer.encode(w, add_special_tokens=False).ids) for w, n in pretokens(text, special).items())
        assert parts == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


def test_token_output_round_trip(spark, odd):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lists = {(r[0], text_of(r)): array("I", [*t.encode(text_of(r), add_special_tokens=False).ids, 2]) for r in odd_rows()}
    got = token_output(odd).collect()
    want = Counter((r[0], len(x), zlib.crc32(x.tobytes())) for r in odd_rows() for x in [lists[r[0], text_of(r)]])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == [0, *itertools.accumulate(r["n_tokens"] for r in got)][:-1]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_orc_files_hold_ids_in_order(spark, odd, tmp_path):
    path = write_orc(odd, str(tmp_path / "tokens"))
    stored = spark.read.orc(path)
    assert set(stored.columns) == {"part", "seq", "doc_id", "ids"}
    assert stored.filter("doc_id = 8").count() == 1
    assert stored.select(F.explode("ids")).count() == encode(odd).select(F.explode("ids")).count()


def test_token_counts(spark, odd):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in odd_rows():
        n = len(t.encode(text_of(r), add_special_tokens=False).ids)
        want[r[0], len(text_of(r).encode()), n, n > 2048] += 1
    for dictionary in (10, 100_000):
        got = Counter(tuple(r) for r in token_counts(odd, dictionary=dictionary).collect())
        assert got == want


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


@pytest.mark.parametrize("dictionary", [5, 100_000])
def test_lm_counts_and_base(spark, odd, dictionary):
    rows = odd_rows()
    tokens = {id(r): [*text_of(r).encode().lower().split(), lm.END] for r in rows}
    c = Counter(w for r in rows if not held_out(r[0]) for w in tokens[id(r)])
    total, distinct = c.total(), len(c)
    small = lm.Shape(least=3, root=0, rare=4, rounds=1)
    got = sorted(lm.lm_scores(odd, shape=small, dictionary=dictionary).collect(), key=lambda r: (r["n_tokens"], r["base_score"]))
    want = sorted(
        (len(x), sum(np.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in x), sum(c[w] > 0 for w in x)) for x in tokens.values()
    )
    assert [(r["n_tokens"], r["n_known"]) for r in got] == [(a, k) for a, _, k in want]
    assert np.allclose([r["base_score"] for r in got], [b for _, b, _ in want])
    assert {r["train_tokens"] for r in got} == {total}
    assert all(r["score"] < 0 for r in got)
    assert {(r["doc_id"], r["held_out"]) for r in got} == {(r[0], held_out(r[0])) for r in rows}


def vocabulary(n: int, rare: int, rng) -> lm.Vocabulary:
    return lm.Vocabulary({lm.END: 5, **{b"w%d" % i: int(c) for i, c in enumerate(rng.integers(1, 90, n))}}, rng.integers(0, 40, rare))


def test_model_is_normalised_and_learns():
    rng = np.random.default_rng(1)
    v = vocabulary(20, 3, rng)
    shape = lm.Shape(width=8, block_noise=4)
    # Symbol k is followed by k + 1, nine times out of ten.
    text = [0]
    for _ in range(60_000):
        text.append((text[-1] + 1) % v.size if rng.random() < 0.9 else int(rng.integers(v.size)))
    trainer = lm.Trainer(lm.Model.fresh(v, shape.width), v, shape, 1)
    for _ in range(4):
        trainer.learn([np.array(text)])
    every = np.arange(v.size)
    for one, two in rng.integers(0, v.size + 1, (20, 2)):
        log = trainer.model.log_probability(v, np.full(v.size, one), np.full(v.size, two), every)
        assert np.isclose(np.exp(log.astype(float)).sum(), 1, atol=1e-4)
    sym = np.array(text)
    one, two = lm.contexts(sym, np.zeros(1, np.int64), v.start)
    assert trainer.model.log_probability(v, one, two, sym).mean() > np.log(1 / v.size) + 1


def test_changes_of_shards_add_up():
    rng = np.random.default_rng(2)
    v = vocabulary(30, 2, rng)
    model = lm.Model.fresh(v, 4)
    trainer = lm.Trainer(model, v, lm.Shape(width=4), 3)
    trainer.learn([rng.integers(0, v.size, 500)])
    for number, rows, seen, change in trainer.changes(model):
        name = lm.TABLES[number]
        moved = np.flatnonzero((trainer.tables[name] != model.tables[name]).any(axis=1))
        assert set(moved) <= set(rows) and (seen > 0).all()
        assert np.allclose(model.tables[name][rows] + change / seen[:, None], trainer.tables[name][rows], atol=1e-5)


@pytest.mark.parametrize("dictionary", [6, 100_000])
def test_lm_scores_equal_a_plain_sum(spark, odd, monkeypatch, dictionary):
    """Every token's probability worked out alone, in double precision, with a model of random numbers."""
    made = {}

    def random_model(train, tokens, v, shape):
        rng = np.random.default_rng(5)
        made["v"] = dict(v.symbol), v.rare_symbol, v.first, v.block, v.size
        made["t"] = {k: rng.normal(0, 0.5, x.shape) for k, x in lm.Model.fresh(v, shape.width).tables.items()}
        return lm.Model({k: x.astype(np.float32) for k, x in made["t"].items()})

    monkeypatch.setattr(lm, "train_model", random_model)
    rows = [r for r in odd_rows() if len(text_of(r)) < 6000]
    shape = lm.Shape(least=4, root=0, rare=3, width=4)
    got = lm.lm_scores(frame(spark, rows), shape=shape, dictionary=dictionary).collect()
    symbol, rare_symbol, first, block, size = made["v"]
    t = made["t"]
    c = Counter(w for r in rows if not held_out(r[0]) for w in [*text_of(r).encode().lower().split(), lm.END])
    others = [w for w in c if w not in symbol]
    want = []
    for r in rows:
        total, one, two = 0.0, size, size
        for w in [*text_of(r).encode().lower().split(), lm.END]:
            s = symbol[w] if w in symbol else int(rare_symbol[lm.ending(w, 3)])
            q = t["before"][one] @ t["places"][:4] + t["before"][two] @ t["places"][4:]
            z = t["block"] @ q + t["block_bias"][:, 0]
            low, high = first[block[s]], first[block[s] + 1]
            y = t["after"][low:high] @ q + t["bias"][low:high, 0]
            total += z[block[s]] - np.log(np.exp(z).sum()) + y[s - low] - np.log(np.exp(y).sum())
            if w not in symbol:
                mine = [o for o in others if lm.ending(o, 3) == lm.ending(w, 3)]
                total += np.log((c[w] + 0.1) / (sum(c[o] for o in mine) + 0.1 * (len(mine) + 1)))
            one, two = s, one
        want.append((r[0], total / np.log(10)))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = sorted(((r["doc_id"], r["score"]) for r in got), key=key)
    want.sort(key=key)
    assert [a for a, _ in got] == [a for a, _ in want]
    assert np.allclose([b for _, b in got], [b for _, b in want], rtol=1e-4, atol=1e-3)


def test_the_model_is_trained_on_every_token(spark, monkeypatch):
    rows = [(i, f"w{i % 7} w{i % 5} w{i % 3}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []

    def counted(train, model, v, shape, number):
        # Symbols are stored in two bytes each, four of them a document.
        seen.append(train.selectExpr("sum(octet_length(symbols)) / 2").first()[0])
        return model

    monkeypatch.setattr(lm, "train_round", counted)
    assert lm.lm_scores(docs).count() == 400
    assert sum(seen) == 4 * sum(not held_out(i) for i, _ in rows)


def test_tasks_of_a_round_read_more_than_they_return(spark, monkeypatch):
    """What is shuffled follows the tokens, though shards and symbols both grow with the corpus."""
    v = vocabulary(5000, 2, np.random.default_rng(2))
    shape = lm.Shape(width=4, shard_tokens=100_000)
    tasks = []

    def counted(train, model, v, shape, number):
        tasks.append(train.rdd.getNumPartitions())
        return model

    monkeypatch.setattr(lm, "train_round", counted)
    train = spark.createDataFrame([(0, b"")], "part int, symbols binary").repartition(64)
    for tokens in (100_000, 400_000, 12_000_000):
        lm.train_model(train, tokens, v, shape)
    assert tasks[:2] == [1, 1] and tasks[2:4] == [2, 2]
    assert all(8 <= n <= 6_000_000 / (100 * v.size) for n in tasks[4:])


def test_a_task_adds_up_its_shards(spark):
    """A round in one task of three shards against the same shards trained alone."""
    rng = np.random.default_rng(4)
    v = vocabulary(30, 2, rng)
    model = lm.Model.fresh(v, 4)
    shape = lm.Shape(width=4, batch=500, shard_tokens=lm.CHUNK, task_shards=3)
    texts = [rng.integers(0, v.size, 10_000).astype(v.stored) for _ in range(25)]
    train = spark.createDataFrame([(0, x.tobytes()) for x in texts], "part int, symbols binary").coalesce(1)
    got = lm.train_round(train, model, v, shape, 1)
    # A shard ends with the chunk that fills it, seven texts here; the last one takes what is left.
    change, seen = dict.fromkeys(lm.TABLES, 0), dict.fromkeys(lm.TABLES, 1e-30)
    for shard, mine in enumerate([[texts[:7]], [texts[7:14]], [texts[14:21], texts[21:]]]):
        trainer = lm.Trainer(model, v, shape, [1, 0, shard])
        for chunk in mine:
            trainer.learn(chunk)
        for k in lm.TABLES:
            weight = (trainer.past[k] - 1e-3).sum(axis=1, keepdims=True)
            change[k], seen[k] = change[k] + weight * (trainer.tables[k] - model.tables[k]), seen[k] + weight
    for k in lm.TABLES:
        assert np.allclose(got.tables[k], model.tables[k] + change[k] / seen[k], rtol=1e-3, atol=1e-4), k


def test_words_are_cut_at_ascii_white_space():
    texts = [b"", b" ", b"\t A\x0bb  B\xc3\x89\x1c\xff \r\n", None, bytes(range(1, 256)), b"a a", "a\u2003B\x85 \u0130".encode(), b"\x00 x"]
    want = [(i, w) for i, t in enumerate(texts) for w in (t or b"").lower().split()]
    for column in (pa.array(texts, pa.binary()), pa.array([b"q", *texts], pa.binary()).slice(1)):
        text, code, distinct = lm.lower_words(column)
        words = distinct.to_pylist()
        assert [(int(i), words[c]) for i, c in zip(text, code)] == want
    for most in (1, 10, 1000):
        cut = list(slices(column, most))
        assert pa.concat_arrays([x for _, x in cut]).equals(column) and [len(texts[:low]) for low, _ in cut] == [low for low, _ in cut]
        assert all(len(x) == 1 or sum(len(t or b"") for t in x.to_pylist()) <= most for _, x in cut)


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_a_step_follows_the_gradient(batch):
    """Steps on consecutive tokens against the same sums made token by token."""
    rng = np.random.default_rng(6)
    v = vocabulary(30, 2, rng)
    shape = lm.Shape(width=4, block_noise=3, word_noise=2, batch=batch)
    texts = [rng.integers(0, v.size, n) for n in (1, 2, 9, 140)]
    starts = np.cumsum([0] + [len(x) for x in texts[:-1]])
    sym = np.concatenate(texts)
    one, two = lm.contexts(sym, starts, v.start)
    trainer = lm.Trainer(lm.Model.fresh(v, 4), v, shape, 3)
    moved: list[dict] = []

    def move(table, rows, gradient):
        if not moved or table in moved[-1]:
            moved.append({})
        full = np.zeros(trainer.tables[table].shape)
        full[rows] = gradient
        moved[-1][table] = full

    trainer._move = move
    draws = trainer.rng = Recorded(4)
    trainer.learn(texts)
    assert len(moved) == -(-len(sym) // batch)
    draws.again()
    t = {k: x.astype(float) for k, x in trainer.tables.items()}
    width = 4
    for number, got in enumerate(moved):
        at = range(number * batch, min(len(sym), (number + 1) * batch))
        want = {k: np.zeros(x.shape) for k, x in t.items()}
        block_noise = np.searchsorted(trainer.block_upto, draws.random(3)).clip(0, v.blocks - 1)
        by_block = {}
        for i in at:
            by_block.setdefault(int(v.block[sym[i]]), []).append(i)
        groups = []
        for b in sorted(by_block):
            mine = sorted(by_block[b], key=lambda i: (sym[i], i))
            groups += [(b, mine[i : i + lm.GROUP]) for i in range(0, len(mine), lm.GROUP)]
        drawn = draws.random((len(groups), 2))
        for (b, mine), d in zip(groups, drawn):
            low, high = v.first[b], v.first[b + 1]
            noise = (np.searchsorted(v.upto, v.upto[low] + d * (v.upto[high] - v.upto[low]), side="right") - 1).clip(low, high - 1)
            for i in mine:
                e = np.concatenate([t["before"][one[i]], t["before"][two[i]]])
                q = e @ t["places"]
                back = np.zeros(width)
                for vectors, bias, word, others, offset in (
                    ("block", "block_bias", b, block_noise, trainer.block_offset),
                    ("after", "bias", sym[i], noise, trainer.word_offset),
                ):
                    for w, data in [(word, 1), *[(o, 0) for o in others]]:
                        off = data - 1 / (1 + np.exp(-(q @ t[vectors][w] + t[bias][w, 0] - offset[w])))
                        want[vectors][w] += off * q
                        want[bias][w] += off
                        back += off * t[vectors][w]
                want["places"] += np.outer(e, back)
                want["before"][one[i]] += t["places"][:width] @ back
                want["before"][two[i]] += t["places"][width:] @ back
        for k in want:
            assert np.allclose(got[k], want[k], rtol=1e-3, atol=1e-4), k


class Recorded:
    """Random numbers that can be had again."""

    def __init__(self, seed: int) -> None:
        self.seed = seed
        self.again()

    def again(self) -> None:
        self.rng = np.random.default_rng(self.seed)

    def random(self, shape):
        return self.rng.random(shape)


def test_lm_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.lm_scores(docs, shape=lm.Shape(share=1)).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (r[0] - r[1]) / r[2] > 0.2


def test_empty_table(spark):
    none = frame(spark, odd_rows()).limit(0)
    assert token_output(none).count() == token_counts(none).count() == 0
    assert lm.lm_scores(none).count() == 0
