"""The manifest, periodic runs and word windows against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import odd_rows, text_of
from pyspark.sql import functions as F

from weirgate.llm import cover_dedup as cd
from weirgate.llm import merkle as mk
from weirgate.llm import periodic_runs as pr
from weirgate.llm.near_dedup import word_hashes


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text) -> str:
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """The top node and, for each node, its place and siblings level by level."""
    paths = [[] for _ in nodes]
    spans = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for low in range(0, len(nodes), 3):
            for k in range(low, min(low + 3, len(nodes))):
                for i in spans[k]:
                    paths[i].append((k - low, nodes[low:k] + nodes[k + 1 : low + 3]))
        spans = [sum(spans[i : i + 3], []) for i in range(0, len(nodes), 3)]
        nodes = [H(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows: list[tuple]) -> Counter:
    """From (doc_id, source, lang, n_chars, text)."""
    by = defaultdict(list)
    for r in rows:
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        other = leaf_of(*r[:4], r[4].replace("\n", "")) if even and r[4] is not None else leaf_of(*r)
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf_of(*r), other, r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by[s])]) for s in names}
    root, upper = plain_tree([trees[s][0] for s in names])
    out = Counter()
    for s, above in zip(names, upper):
        for x, path in zip(sorted(by[s]), trees[s][1]):
            folded = x[3]
            for place, others in path + above:
                folded = H(*others[:place], folded, *others[place:])
            out[x[4], x[2], trees[s][0], root, H(*(o for _, others in path + above for o in others)), folded, folded == root] += 1
    return out


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_a_plain_tree(spark, odd, levels):
    want = plain_manifest([tuple(r) for r in odd.select(*FIELDS).collect()])
    got = Counter(tuple(r) for r in mk.digest(mk.tampered(odd, levels)).collect())
    assert got == want


def test_manifest_of_one_hot_row(spark, monkeypatch):
    inner = mk.Block

    def bounded(nodes, n, arity, levels):
        assert len(nodes) <= arity**levels
        return inner(nodes, n, arity, levels)

    monkeypatch.setattr(mk, "Block", bounded)
    rows = [(5, "a", "en", 3, "a\nb")] * 300 + [(i, "abé"[i % 3], None, i, f"t\n{i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    want = plain_manifest(rows)
    assert {r[-1] for r in want} == {True, False}
    assert Counter(tuple(r) for r in mk.digest(mk.tampered(docs, 3)).collect()) == want


def test_manifest_of_an_empty_table_and_of_one_row(spark, odd):
    assert mk.digest(mk.tampered(odd.limit(0))).count() == 0
    one = odd.filter("doc_id = 3").select(*FIELDS)
    got = mk.digest(mk.tampered(one)).collect()
    assert Counter(tuple(r) for r in got) == plain_manifest([tuple(r) for r in one.collect()])
    assert got[0]["leaf"] == got[0]["subroot"] == got[0]["root"] and got[0]["proof_sha256"] == H("")


def brute_runs(w: list, least: int) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(w) // 2 + 1):
        for same, part in itertools.groupby(range(len(w) - q), key=lambda i: w[i] == w[i + q]):
            part = list(part)
            s = w[part[0] : part[-1] + q + 1]
            if same and len(s) >= max(least, 2 * q) and not any(s[p:] == s[:-p] for p in range(1, q)):
                out.append((part[0], len(s), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng: random.Random) -> list[str]:
    w = [f"w{rng.randrange(rng.choice([1, 2, 3, 9]))}" for _ in range(rng.randint(0, 70))]
    if len(w) > 5 and rng.random() < 0.6:
        a = rng.randrange(len(w))
        p = rng.randint(1, 1 + (len(w) - a) // 2)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(5)
    fibonacci, next_ = ["a"], ["a", "b"]
    while len(next_) < 150:
        fibonacci, next_ = next_, next_ + fibonacci
    for w in [next_, ["x"] * 40, *(periodic_words(rng) for _ in range(500))]:
        assert pr.stretch_runs(w, 2) == brute_runs(w, 2)
        words = [x.encode() for x in w]
        hashes = word_hashes(np.frombuffer(b" ".join(words) + b" ", np.uint8))[1]
        assert pr.runs_of(words, hashes) == brute_runs(w, 12)


def test_last_ends_are_those_of_a_plain_scan():
    rng = random.Random(7)
    for _ in range(60):
        w = [rng.randrange(3) for _ in range(rng.randint(1, 40))]
        automaton = pr.Automaton(w)
        tree = pr.LastEnds(automaton)
        for i, state in enumerate(automaton.prefix):
            got = {}
            for j, longest in tree.access(state, i):
                got[j] = max(got.get(j, 0), longest)
            # The last end before i of every suffix of the prefix, and the longest suffix for each such end.
            want = {}
            for n in range(1, i + 2):
                for j in range(i - 1, n - 2, -1):
                    if w[j - n + 1 : j + 1] == w[i - n + 1 : i + 1]:
                        want[j] = n
                        break
            assert {j: n for j, n in got.items() if n} == want


def plain_runs(doc_id, text) -> tuple:
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 12)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    ratio = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, ratio, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_periodic_runs_equal_brute_force(spark, odd):
    rng = random.Random(9)
    rows = [(r[0], r[1]) for r in odd_rows() if len(text_of(r)) < 10_000]
    rows += [(1000 + i, " \n".join(periodic_words(rng))) for i in range(300)]
    rows += [(7, "a b c d " * 9)] * 200 + [(None, "x " * 30), (21, "é\x0bü\x1f " * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"h": F.lit(1), "words": F.lit("x"), "runs": F.lit(2)}).repartition(5)
    got = pr.digest(pr.periodic_runs(pr.planted(docs))).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_runs(*r) for r in rows)
    found = {r["doc_id"]: r for r in pr.periodic_runs(docs).filter("doc_id = 7").limit(1).collect()}
    assert found[7]["kept"] == "a b c d" and [tuple(r) for r in found[7]["runs"]] == [(0, 36, 4)]
    assert pr.digest(pr.periodic_runs(pr.planted(odd.limit(0)))).count() == 0


def test_a_very_long_periodic_text():
    words = [f"w{i % 700}".encode() for i in range(60_000)]
    hashes = word_hashes(np.frombuffer(b" ".join(words) + b" ", np.uint8))[1]
    assert pr.runs_of(words, hashes) == [(0, 60_000, 700)]


def plain_removed(rows: list[tuple]) -> Counter:
    texts = [(r[1] or "").encode().split() for r in rows]
    windows = [[tuple(t[i : i + 35]) for i in range(len(t) - 34)] for t in texts]
    count = Counter(w for ws in windows for w in ws)
    out = Counter()
    for r, t, ws in zip(rows, texts, windows):
        gone = {k for i, w in enumerate(ws) if count[w] > 1 for k in range(i, i + 35)}
        kept = b" ".join(w for i, w in enumerate(t) if i not in gone)
        out[r[0], len(t), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_the_cover_reaches_every_pair_of_places():
    for i in range(cd.PERIOD):
        for j in range(cd.PERIOD):
            assert any((i + k) % cd.PERIOD in cd.COVER and (j + k) % cd.PERIOD in cd.COVER for k in range(cd.PERIOD))


def word_rows(rng: random.Random) -> list[tuple]:
    base = [[f"w{rng.randrange(300)}" for _ in range(200)] for _ in range(4)]
    rows = [(None, None), (1, ""), (2, "z " * 90), (3, "a b " * 40), (None, "a b " * 17), (4, "é " * 34)]
    for i in range(80):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = f"own{rng.random()}"
        t = [f"p{rng.random()}" for _ in range(rng.randint(0, 30))] + t[rng.randint(0, 100) : rng.randint(110, 200)]
        if rng.random() < 0.2:
            t += t[3:45]
        rows.append((10 + i, rng.choice([" ", "\n\t"]).join(t)))
    return rows


@pytest.mark.parametrize("parts", [1, 9])
def test_word_windows_equal_brute_force(spark, parts):
    rows = word_rows(random.Random(11))
    rows += [(10 + i, rows[20][1]) for i in range(50)] + [rows[21]] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "h": F.lit(2), "place": F.lit("x")}).repartition(parts)
    assert Counter(tuple(r) for r in cd.digest(cd.repeated_words(docs)).collect()) == plain_removed(rows)
    spans = {r["doc_id"]: r for r in cd.repeated_words(docs).filter("doc_id IN (2, 4)").collect()}
    assert spans[2]["spans"] == [0, 90] and spans[2]["kept"] == "" and spans[4]["spans"] == []


def test_word_windows_of_odd_rows(spark, odd):
    got = Counter(tuple(r) for r in cd.digest(cd.repeated_words(odd)).collect())
    assert got == plain_removed([(r[0], r[1]) for r in odd_rows()])
    assert cd.repeated_words(odd.limit(0)).count() == 0


def test_a_hot_hash_has_one_row_a_batch(spark):
    common = " ".join(f"c{i}" for i in range(60))
    rng = random.Random(3)
    rows = [(i, " ".join(f"o{rng.random()}" for _ in range(rng.randint(1, 21))) + " " + common) for i in range(400)]
    docs = cd._keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    hashes = cd._anchor_rows(docs).filter("spot % 4 < 2").groupBy("h").count()
    assert hashes.agg(F.max("count")).first()[0] <= 3
    assert Counter(tuple(r) for r in cd.digest(cd.repeated_words(docs)).collect()) == plain_removed(rows)
