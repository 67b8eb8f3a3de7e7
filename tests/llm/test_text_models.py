"""Language identification, quality and decontamination."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from odd import odd_rows, text_of
from pyspark.sql import functions as F

from weirgate.llm import decontamination as dc
from weirgate.llm import language_id as li
from weirgate.llm import quality as qu



@pytest.fixture(scope="module")
def pieces():
    return li.Pieces()


def test_forward_sums_all_segmentations(pieces):
    rng = np.random.default_rng(2)
    probability = np.vstack([rng.random((len(pieces.pieces), 2)) * 0.01, np.zeros(2)])
    index = {p: i for i, p in enumerate(pieces.pieces)}

    def brute(word: str) -> np.ndarray:
        if not word:
            return np.ones(2)
        total = np.zeros(2)
        for n in range(1, len(word) + 1):
            head = word[:n]
            p = probability[index[head]] if head in index else np.full(2, li.UNKNOWN) if n == 1 else None
            if p is not None:
                total += p * brute(word[n:])
        return total

    words = ["the", "erthand", "éleçaux", "x", "日本", "qzq"]
    for at, chars in li.grouped(words):
        got = li.forward(li.found(pieces, chars), probability, *chars.shape)[-1]
        for i, g in zip(at, got):
            assert np.allclose(g, brute(li.MARK + words[i]))


def test_long_words_are_summed_like_short_ones(pieces):
    rng = np.random.default_rng(4)
    probability = np.vstack([rng.random((len(pieces.pieces), 2)) * 0.1, np.zeros(2)])
    for word in ["internationalisation", "x", "ßéçaux" * 6, "日本語the" * 4]:
        ((_, chars),) = li.grouped([word])
        want = np.log(li.forward(li.found(pieces, chars), probability, *chars.shape)[-1][0])
        assert np.allclose(li.long_forward(pieces, word, probability), want)


def test_long_words_do_not_depend_on_the_window(pieces, monkeypatch):
    rng = np.random.default_rng(4)
    probability = np.vstack([rng.random((len(pieces.pieces), 2)) * 0.1, np.zeros(2)])
    word = "".join(rng.choice(list("etaoinßé日"), 3000))
    want = li.long_forward(pieces, word, probability)
    monkeypatch.setattr(li, "_WINDOW", 37)
    assert np.allclose(li.long_forward(pieces, word, probability), want) and np.isfinite(want).all()


def test_letters_are_those_of_unicode():
    assert li.letter_words("² ½ Ⅷ 12 _") == []
    assert li.letter_words("ab²cd Été½x ⅧIV 漢字") == ["ab", "cd", "été", "x", "iv", "漢字"]


def test_texts_of_signs_have_no_language(spark):
    train = [(i, f"the house {i}", "en") for i in range(40)] + [(50 + i, f"la maison {i}", "fr") for i in range(40)]
    docs = spark.createDataFrame([*train, (200, "² ½ Ⅷ", "en"), (201, "the " + "x" * 100_000, "en")], "doc_id long, text string, lang string")
    said = {r["doc_id"]: r for r in li.identify(docs).collect()}
    assert said[200]["lang_pred"] == "und" and said[200]["score"] == 0
    assert said[201]["lang_pred"] in ("en", "fr") and 0 < said[201]["score"] <= 1


def test_hash_table_finds_exactly_the_pieces(pieces):
    for at, chars in li.grouped([p[1:] for p in pieces.pieces if p.startswith(li.MARK) and len(p) > 1][:2000]):
        spans = li.found(pieces, chars)
        n = chars.shape[1]
        for (a, b), got in spans.items():
            for row, g in zip(chars[:50], got[:50]):
                text = row[a:b].tobytes().decode("utf-32-le")
                assert (pieces.pieces[g] if g >= 0 else None) == (text if text in set(pieces.pieces[i] for i in [g] if i >= 0) else None)
        assert (spans[0, n] >= 0).all()


def test_languages(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = li.identify(docs, per_language=60).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert held[0] > 0.97 and 0 <= held[1] <= held[2] <= 1
    rows = li.identify(odd).collect()
    assert len(rows) == len(odd_rows())
    said = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all(said[i]["lang_pred"] == "und" and said[i]["score"] == 0 for i in (0, 1, 2, 10))
    assert {r["lang_pred"] for r in rows} <= {"und", "en", "fr"}
    kept = li.keep_identified(odd)
    assert kept.columns == odd.columns and not {0, 1, 2, 10} & {r["doc_id"] for r in kept.collect()}
    assert li.identify(odd.limit(0)).count() == 0
    assert {r["lang_pred"] for r in li.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_the_language_model_is_fitted_in_tasks(spark, monkeypatch):
    rows = [(i, f"the house of {chr(97 + i % 26)}{i} été", "en") for i in range(60)] + [(100 + i, f"la maison {i} d'été", "fr") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    bags = Counter((w, lang) for _, text, lang in rows for w in li.letter_words(text))
    words, pieces = sorted({w for w, _ in bags}), li.Pieces()
    weights = np.array([[bags[w, lang] for lang in ("en", "fr")] for w in words], float)
    want = li._smoothed(np.array([[2.0 ** -len(p)] * 2 for p in pieces.pieces]))
    for _ in range(3):
        into = np.zeros((len(pieces.pieces), 2))
        for at, chars in li.grouped(words):
            li.expected(li.found(pieces, chars), want, chars.shape[1], weights[at], into)
        want = li._smoothed(into)

    def refused(*_):
        raise AssertionError("pieces belong to the tasks")

    monkeypatch.setattr(li, "Pieces", refused)
    got = li.fit(docs, F.lit(True))
    assert got.names == ["en", "fr"] and np.allclose(got.probability, want)
    monkeypatch.undo()
    none = docs.withColumn("text", F.lit("12"))
    assert li.fit(none, F.lit(True)).probability.shape == want.shape


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = qu.quality_scores(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    bad, good = got[got.quality == 0].score, got[got.quality == 1].score
    assert np.mean([b < g for b in bad for g in good]) > 0.95
    assert (got.predicted == (got.score >= 0.3)).all()


def test_quality_sees_the_whole_text_and_takes_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, q, 0) for i, q in [(3, 1), (4, 1), (5, 1), (7, 0), (None, 1), (8, None), (999, 0)] + [(100 + i, i % 2) for i in range(30)]], "doc_id long, quality int, toxic int")
    got = qu.quality_scores(odd, labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert qu.quality_scores(odd, labels.limit(0)).filter("score = 0.5").count() == len(odd_rows())
    assert qu.quality_scores(odd.limit(0), labels).count() == 0
    rng = random.Random(4)
    clean = [" ".join(rng.choice(["tion", "the", "er"]) for _ in range(rng.randint(1, 300))).encode() for _ in range(60)]
    bad = [c[: len(c) // 2] + b" %%% $$$ %%% " + c[len(c) // 2 :] for c in clean]
    net = qu.fit(clean + bad, np.array([1.0] * 60 + [0.0] * 60, np.float32), np.ones(120, np.float32))
    long_ = b"the tion er " * 60_000
    score = qu.scores(net, [long_, long_ + b"%%% $$$ %%% $$$", b""])
    assert score[0] > 0.6 > score[1]
    assert np.allclose(score, [qu.scores(net, [t])[0] for t in (long_, long_ + b"%%% $$$ %%% $$$", b"")])


def brute_hits(text: str, items: list[tuple]) -> tuple:
    words, hit, names = dc.words_of(text.encode()), set(), set()
    for name, item in items:
        for w in dc.windows_of(dc.words_of((item or "").encode())):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    names.add("" if name is None else str(name))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_decontamination_equals_brute_force(spark, odd):
    rows, rng = odd_rows(), random.Random(5)
    words = [w for r in rows for w in text_of(r).split()[:50]]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 14)))) for i in range(30)]
    items += [(50, " ".join(text_of(rows[4]).split()[20:45]).upper()), (50, "one two"), (None, " ".join(text_of(rows[3]).split()[-12:])), (51, None), (52, ""), (53, "two"), (54, "!!")]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = Counter((r[0], *brute_hits(text_of(r), items)) for r in rows)
    for block in (1 << 20, 9):
        got = dc.digest(dc.occurrences(odd, table, block_windows=block)).collect()
        assert Counter(tuple(r) for r in got) == want
    clean = dc.decontaminate(odd, table)
    assert clean.columns == odd.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(r[0] for r in rows if not brute_hits(text_of(r), items)[-1])
    assert dc.digest(dc.occurrences(odd, table.limit(0))).filter("contaminated").count() == 0
    assert dc.digest(dc.occurrences(odd.limit(0), table)).count() == 0


def test_a_long_item_is_searched_for_in_blocks(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(500)]
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 30])) for i in range(40)] * 3, "doc_id long, text string")
    bench = spark.createDataFrame([("long", " ".join(words[:300]))], "item_id string, text string")
    assert len(dc.matchers(bench, block_windows=50)) == 6
    got = dc.digest(dc.occurrences(docs, bench, block_windows=50)).collect()
    assert len(got) == 120 and all(r["n_hit"] == 30 and r["n_items"] == 1 for r in got)


def test_a_repeated_id_is_collected_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(qu, "fit", lambda texts, y, weights: seen.append((texts, y)))
    rows = [(1, f"text {i}") for i in range(300)] + [(i, f"own {i}") for i in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    qu.train(docs, labels, F.lit(True))
    assert len(seen[0][0]) == 29 and seen[0][0][0] == b"text 0"


def test_search_skips_and_finds_overlapping_patterns():
    a = [(b"x",) * 10, tuple(b"%d" % i for i in range(10)), (b"x",) * 9 + (b"y",)]
    t = dc.Tables(a)
    text = [b"z"] * 7 + [b"x"] * 12 + [b"y"] + [b"%d" % i for i in range(10)]
    want = {(i, p) for p in a for i in range(len(text)) if tuple(text[i : i + 10]) == p}
    assert set(t.search(text)) == want and len(want) == 5
