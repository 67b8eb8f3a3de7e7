"""Near-dedup of texts and vectors, substring dedup, mixing and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import odd_rows, text_of
from pyspark.sql import functions as F

from weirgate.llm import mixing as mx
from weirgate.llm import near_dedup as nd
from weirgate.llm import substring_dedup as sd
from weirgate.llm import vector_dedup as vd


def roots(ids: list, linked) -> dict:
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    for _ in range(3):
        key = nd.mixed(np.arange(40, dtype=np.uint64))
        x, y = rng.integers(1, 40, 40), rng.integers(1, 40, 40)
        got = nd.signatures([(key, x), (key, y)], 4096)
        want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
        assert abs((got[0] == got[1]).mean() - want) < 0.04


def edited_copies(rng: random.Random, n: int, most: int) -> list[str]:
    base = [f"w{rng.randint(0, 500)}" for _ in range(150)]
    out = []
    for _ in range(n):
        words = base[:]
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(150)] = f"e{rng.random()}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("large,rare", [(4, 3), (64, 32)])
def test_near_classes_equal_brute_force(spark, monkeypatch, large, rare):
    monkeypatch.setattr(nd, "LARGE", large)
    monkeypatch.setattr(nd, "RARE", rare)
    rng = random.Random(2)
    texts = edited_copies(rng, 60, 12) + edited_copies(rng, 8, 2) + [" ".join(f"u{rng.random()}" for _ in range(30)) for _ in range(30)]
    texts += [texts[3]] * 20 + ["a b", "a b", "a b c"]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if nd.overlap(texts[i].encode(), texts[j].encode()) >= 0.8]
    want = roots(list(range(len(texts))), linked)
    got = nd.near_classes(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert {r["doc_id"] for r in got if r["kept"]} == set(want.values())


def test_near_classes_of_odd_rows(spark, odd):
    got = nd.near_classes(odd).collect()
    assert len(got) == len(odd_rows())
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add(r["class_id"])
    assert by[4] == by[5] == by[6] == {4} and 4 in by[None] and by[8] == by[9] == {8}
    assert by[0] == {0} and by[1] == {1}
    kept = nd.drop_near_copies(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[4] == 1 and not ids[5] and not ids[6] and not ids[9] and ids[0] == ids[1] == ids[None] == 1
    assert nd.near_classes(odd.limit(0)).count() == 0


def brute_spans(texts: list[bytes]) -> list[np.ndarray]:
    seen = Counter(t[i : i + sd.LENGTH] for t in texts for i in range(len(t) - sd.LENGTH + 1))
    out = []
    for t in texts:
        marks = np.zeros(len(t), bool)
        for i in range(len(t) - sd.LENGTH + 1):
            if seen[t[i : i + sd.LENGTH]] > 1:
                marks[i : i + sd.LENGTH] = True
        out.append(marks)
    return out


@pytest.mark.parametrize("group", [1, 256])
def test_substrings_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(sd, "GROUP", group)
    rng = random.Random(6)
    base = ["".join(rng.choices("abcdé ", k=1300)) for _ in range(3)]
    rows = [(None, None), (1, ""), (2, "z" * 900), (3, "ab" * 300), (4, base[0]), (4, base[0]), (None, base[1][:399]), (5, base[1][:700] + base[2][300:900] + base[1][:700])]
    for i in range(25):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = "#"
        rows.append((10 + i, "".join(t)[rng.randint(0, 300) : rng.randint(800, 1300)]))
    raw = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for r, t, m in zip(rows, raw, brute_spans(raw)):
        runs = int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())
        want[r[0], len(t), int(m.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest()] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("a", F.lit(2)).repartition(4)
    assert Counter(tuple(r) for r in sd.digest(sd.repeated_spans(docs)).collect()) == want
    assert sd.repeated_spans(docs.limit(0)).count() == 0


def test_mergesort_is_lexicographic():
    rng = random.Random(8)
    contents = [bytes(rng.choices(b"ab", k=rng.randint(1, 40))) for _ in range(50)]
    sizes = np.array([17, 1, 32])
    order = sd.Suffixes(contents, np.zeros(50, int)).sorted_groups(sizes)
    for a, b in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes)):
        assert [contents[i] for i in order[a:b]] == sorted(contents[a:b])


def test_substrings_of_odd_rows(spark, odd):
    got = {r["doc_id"]: r for r in sd.repeated_spans(odd).collect()}
    assert bytes(got[4]["kept"]) == b"" and bytes(got[8]["kept"]) == b"one two" and bytes(got[7]["kept"]) == b""


def unit(v):
    return v / np.linalg.norm(v)


@pytest.mark.parametrize("sizes", [(512, 4096), (12, 24)])
def test_vectors_equal_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(vd, "TARGET", sizes[0])
    monkeypatch.setattr(vd, "LIMIT", sizes[1])
    rng = np.random.default_rng(3)
    ball = unit(rng.normal(size=16))
    rows = [(i, unit(ball + rng.normal(size=16) * 0.02).tolist(), 1) for i in range(80)]
    rows += [(100 + i, rng.normal(size=16).tolist(), i % 3) for i in range(120)]
    rows += [(300 + i, (np.array(rows[90 + i][1]) * 3).tolist(), rows[90 + i][2]) for i in range(10)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 16, 1), (403, [None, *[1.0] * 15], 1), (404, [math.nan] * 16, 1), (405, rows[0][1], None), (406, rows[0][1], 2), (407, rows[0][1][:8], 1), (None, rows[0][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("row", F.lit(1)).withColumn("node", F.lit("x")).repartition(4)

    def valid(r):
        return r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])

    linked, count = [], Counter()
    for i, x in enumerate(rows):
        for j, y in enumerate(rows[:i]):
            if valid(x) and valid(y) and x[2] == y[2] and len(x[1]) == len(y[1]) and unit(np.array(x[1])) @ unit(np.array(y[1])) >= 0.98:
                linked.append((i, j))
                count[i] += 1
                count[j] += 1
    place = roots(list(range(len(rows))), linked)
    least = defaultdict(lambda: math.inf)
    for i, r in enumerate(rows):
        least[place[i]] = min(least[place[i]], math.inf if r[0] is None else r[0])
    got = vd.vector_classes(table).collect()
    assert Counter((r["vec_id"], r["component_id"]) for r in got) == Counter((r[0], least[place[i]] if least[place[i]] < math.inf else None) for i, r in enumerate(rows))
    # Counts are audited, not certain, where a group lies across shards.
    found = sum(r["n_links"] for r in got)
    assert all(r["n_links"] <= max(count[i] for i, x in enumerate(rows) if x[0] == r["vec_id"]) for r in got)
    assert found >= 0.99 * sum(count.values())
    assert vd.vector_classes(table.limit(0)).count() == 0


def brute_targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        by = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if by[s] > 2 * sizes[s]}
        if not over:
            return {**{s: 2.0 * sizes[s] for s in full}, **by}
        full |= over


@pytest.mark.parametrize("rows", [8, 1024])
def test_mix_meets_its_targets(spark, odd, rows):
    words = {i: len(text_of(r).encode().split()) for i, r in enumerate(odd_rows())}
    sizes = Counter()
    for i, r in enumerate(odd_rows()):
        sizes[r[3]] += words[i]
    want = brute_targets(dict(sizes))
    got = mx.mix(odd, block_rows=rows).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], words[i]) for i, r in enumerate(odd_rows()))
    taken = Counter()
    for r in got:
        assert 0 <= r["copies"] <= 2 and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["copies"] * r["size"]
    for s in sizes:
        most = max(w for i, w in words.items() if odd_rows()[i][3] == s)
        assert abs(taken[s] - want[s]) <= most
    again = mx.mix(odd.repartition(7), block_rows=rows).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["copies"])
    assert [(r["doc_id"], r["size"], r["copies"]) for r in sorted(got, key=key)] == [(r["doc_id"], r["size"], r["copies"]) for r in sorted(again, key=key)]
    assert mx.mix(odd.limit(0)).count() == 0
    repeated = mx.take(odd, block_rows=rows)
    assert repeated.columns == odd.columns and repeated.count() == sum(r["copies"] for r in got)


def test_flight_keeps_the_balance():
    rng = np.random.default_rng(4)
    p, size = rng.random(500), rng.integers(0, 1000, 500)
    out = mx.fly(p, size, 1, land=False)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert math.isclose(out.sum(), p.sum(), abs_tol=1e-5) and math.isclose(out @ size, p @ size, rel_tol=1e-7)
    landed = mx.fly(p, size, 1, land=True)
    assert set(landed) <= {0.0, 1.0} and abs(landed @ size - p @ size) < 50
    # Over many draws a document is taken as often as its probability says.
    some = np.mean([mx.fly(p[:40], size[:40], s, land=False) for s in range(400)], axis=0)
    assert np.abs(some - p[:40]).max() < 0.12


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    from weirgate.session import cut_lineage

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, bench = docs.columns, spark.read.parquet(f"{folder}/benchmark.parquet")
    kept = []
    for _, stage in cp.STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, folder))
        assert docs.columns == names
        kept.append(docs)
    language, near, clean, mixed = kept
    assert language.filter("text IS NULL OR NOT text RLIKE '\\\\p{L}'").isEmpty()
    assert nd.near_classes(near).filter("NOT kept").isEmpty() and 0 < near.count() < language.count()
    from weirgate.llm.decontamination import digest, occurrences

    assert digest(occurrences(clean, bench)).filter("contaminated").isEmpty()
    assert mixed.groupBy("doc_id").count().filter("count > 2").isEmpty()
    assert cp.STAGES[-1][1](spark, mixed, folder).count() == mixed.count()


def test_substring_match_past_a_neighbour_without_room():
    rng = random.Random(12)
    left, right = rng.randbytes(300), rng.randbytes(100)
    # Sorted by what follows, the content that starts at the anchor lies between the two that share 400 bytes.
    group = [(left + right + b"a", 300), (right + b"b" + rng.randbytes(320), 0), (left + right + b"c", 300)]
    assert sd.repeated_starts([group]) == [[[0, 0], [], [0, 0]]]
    assert sd.repeated_starts([group[:2], group, group[1:]]) == [[[], []], [[0, 0], [], [0, 0]], [[], []]]


def test_copies_of_a_text_send_a_content_once(spark):
    rng = random.Random(13)
    text = "".join(rng.choices("abcdef ", k=900))
    docs = spark.createDataFrame([(1, text)] * 40 + [(2, text[::-1])], "key long, text string").repartition(6)
    wanted = sd.segments(docs.distinct()).select("key", "a", "c", F.lit(False).alias("many")).cache()
    assert sd._fetch(wanted, docs).count() == wanted.count() > 0


def test_repeated_rows_are_spread_over_blocks(spark, monkeypatch):
    inner = mx._block_work

    def bounded(level, last):
        work = inner(level, last)

        def run(key, table):
            assert table.num_rows <= 64
            return work(key, table)

        return run

    monkeypatch.setattr(mx, "_block_work", bounded)
    rows = [(1, "one two three", "x")] * 400 + [(i, f"w{i} v", "xy"[i % 2]) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    a, b = (Counter(tuple(r) for r in mx.mix(docs.repartition(n), block_rows=16).select("doc_id", "copies").collect()) for n in (3, 7))
    assert a == b and a.total() == len(rows)


def test_bags_at_hand_are_bounded():
    made = []
    of = nd.remembered(lambda text: made.append(text) or nd.bag(text), most=4 << 20)
    texts = [b"%d " % i + b"a b c d e f " * 87_000 for i in range(64)]  # about 1 MB each
    for a, b in zip(texts, texts[1:]):
        of(a), of(b)
    held = of.__closure__
    kept = next(c.cell_contents for c in held if isinstance(c.cell_contents, dict))
    assert sum(map(len, kept)) <= 4 << 20 and len(made) < 2 * 64
    assert of(b"x" * (5 << 20)) == nd.bag(b"x" * (5 << 20)) and sum(map(len, kept)) <= 4 << 20


def test_powers_of_long_texts_are_not_kept():
    up, down = nd._powers((1 << 20) + 5)
    assert len(up) >= (1 << 20) + 5 and len(nd._kept_powers()[0]) == 1 << 20
    assert ((up[: 1 << 20] == nd._kept_powers()[0]) & (up * down == 1)[: 1 << 20]).all()


def test_workers_hold_one_operators_state_at_a_time():
    from weirgate.llm import common

    common.let_go()
    assert common.held("a", 1, lambda: "x") == "x" and common.held("a", 1, lambda: "y") == "x"
    common.let_go(but="a")
    assert len(common._HELD) == 1
    assert common.held("b", 1, lambda: "z") == "z" and list(common._HELD) == [("b", 1)]
    common.let_go(but="a")
    assert not common._HELD
