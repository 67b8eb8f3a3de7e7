"""Runs of periodic words in a text: maximal stretches that repeat their first words at least twice.

A run is a stretch of words with smallest period q that no neighbouring word extends; it counts from
``max(LEAST, 2 * q)`` words on. Runs come from a suffix automaton whose link tree keeps, for every
substring, where it ended last. Appending word i gives the path from the state of the prefix up to the
root the colour i, by access in a link-cut tree. Before that, each piece of the path with one colour j
says that its longest string, of length L, ended last at j and now ends at i. If the distance d = i - j
is at most L, the last L + d words have period d and hold a square. The first square of every run shows
up so, as a primitive word has no occurrence inside its own square but the two; d is the smallest period,
as a smaller one would be a later end. The start i - d - L + 1 stays the same while the run lasts, so the
squares of one (start, period) add up to the run. An access costs amortised logarithmic time.

Every word of a run lies in six words that occur twice in the text (a run of twelve words or more repeats
at least six at the distance of its period), so the automaton is built over the stretches that such words
cover, which are judged apart; words in between are in no run.

Texts are worked off one by one, in the tasks that read them, and nothing is shuffled; the automaton
takes some 500 bytes for each covered word of the text at hand. Null and empty texts have no words and no
runs. Repeated rows and ids are rows of their own with equal results. An empty table gives no rows; other
columns are ignored whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import WORD, map_batches, raw_texts
from weirgate.llm.near_dedup import mixed, shingle_hashes, word_hashes
from weirgate.operators.once import computed_once

#: Words of the shortest run.
LEAST = 12
_HALF = LEAST // 2


class Automaton:
    """Suffix automaton of a sequence: ``length`` and ``link`` of its states, ``prefix``: the states of the prefixes."""

    def __init__(self, sequence: list[int]) -> None:
        self.length, self.link, self.prefix = [0], [-1], []
        length, link, step, last = self.length, self.link, [{}], 0
        for symbol in sequence:
            state = len(length)
            length.append(length[last] + 1)
            step.append({})
            p = last
            while p >= 0 and symbol not in step[p]:
                step[p][symbol] = state
                p = link[p]
            if p < 0:
                link.append(0)
            else:
                target = step[p][symbol]
                if length[target] == length[p] + 1:
                    link.append(target)
                else:
                    link.append(state + 1)
                    length.append(length[p] + 1)
                    step.append(dict(step[target]))
                    link.append(link[target])
                    link[target] = state + 1
                    while p >= 0 and step[p].get(symbol) == target:
                        step[p][symbol] = state + 1
                        p = link[p]
            self.prefix.append(state)
            last = state


class LastEnds:
    """Link-cut tree over the link tree; a preferred path has one colour, kept at the root of its splay tree."""

    def __init__(self, automaton: Automaton) -> None:
        n = len(automaton.length)
        self.length = automaton.length
        self.parent = [p + 1 for p in automaton.link]  # state s is node s + 1, 0 is none
        self.parent.insert(0, 0)
        self.left, self.right = [0] * (n + 1), [0] * (n + 1)
        self.colour = [-1] * (n + 1)

    def _rotate(self, x: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        y = parent[x]
        z = parent[y]
        if left[z] == y:
            left[z] = x
        elif right[z] == y:
            right[z] = x
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            parent[inner] = y
        parent[y], parent[x] = x, z

    def _splay(self, x: int) -> None:
        """``x`` becomes the root of its splay tree and takes the tree's colour."""
        parent, left, right = self.parent, self.left, self.right
        root = x
        while (up := parent[root]) and (left[up] == root or right[up] == root):
            root = up
        if root == x:
            return
        self.colour[x] = self.colour[root]
        above = parent[root]
        while (y := parent[x]) != above:
            z = parent[y]
            if z != above:
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            self._rotate(x)

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Colours the path of ``state`` with ``end``; (last end, longest string) of the pieces it had before."""
        parent, right, colour, length = self.parent, self.right, self.colour, self.length
        pieces, below, x = [], 0, state + 1
        while x:
            self._splay(x)
            if colour[x] >= 0:
                pieces.append((colour[x], length[x - 1]))
            # What lies deeper leaves the path and keeps its colour.
            deeper = right[x]
            if deeper:
                colour[deeper] = colour[x]
            right[x] = below
            below, x = x, parent[x]
        colour[below] = end
        return pieces


def stretch_runs(sequence: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, by start and period."""
    automaton = Automaton(sequence)
    ends = LastEnds(automaton)
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(automaton.prefix):
        for j, longest in ends.access(state, i):
            if longest >= i - j:
                found[j - longest + 1, i - j] = i
    runs = ((start, end - start + 1, period) for (start, period), end in found.items())
    return sorted((r for r in runs if r[1] >= least), key=lambda r: (r[0], r[2]))


def runs_of(words: list[bytes], hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs of a text from its words and their hashes."""
    if len(words) < LEAST:
        return []
    grams = shingle_hashes(hashes, _HALF)
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    if not same.any():
        return []
    edge = np.zeros(len(words) + 1, np.int64)
    edge[: len(grams)] += twice
    edge[_HALF : _HALF + len(grams)] -= twice
    turn = np.diff(np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)]))
    out = []
    for low, high in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist()):
        if high - low >= LEAST:
            numbers: dict[bytes, int] = {}
            stretch = [numbers.setdefault(w, len(numbers)) for w in words[low:high]]
            out += [(low + start, length, period) for start, length, period in stretch_runs(stretch)]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left when each run keeps its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    dropped = np.cumsum(edge) > 0
    return b" ".join(w for w, d in zip(words, dropped.tolist()) if not d)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``kept`` (the text with each run's first period only)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        size, runs, kept = [], [], []
        for text in raw_texts(batch.column("text")):
            words = text.split()
            found = runs_of(words, word_hashes(np.frombuffer(text + b" ", np.uint8))[1])
            size.append(len(words))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            kept.append(collapsed(words, found))
        entry = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        arrays = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(runs, entry), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_batches(rows, work, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where a tenth of the texts (crc32 of the id as text) becomes periodic from some word on.

    With n words, h the hash and g = floor(h / 10), the words from a = g mod n on repeat the first
    p = 1 + floor((n - a) / (3 + g mod 8)) of them. Null ids, and texts without words, stay as they are.
    """
    # The id's crc32 as a column of its own, so that texts of other rows are never cut into words.
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = computed_once(docs.select("doc_id", F.col("text").cast("string").alias("text")), h=h)
    chosen = F.col("h") % 10 == 0
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    rows = computed_once(rows, words=words)
    g, n = F.floor(F.col("h") / 10), F.size("words")
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    head: Column = F.slice("words", F.lit(1), a)
    body = F.slice("words", a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    periodic = F.slice(F.concat(head, F.flatten(F.array_repeat(body, times))), F.lit(1), n)
    return rows.select("doc_id", F.when(chosen & (n > 0), F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    # The greatest length, then the smallest start and period, is the least of these.
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.select("doc_id", "kept", F.size("runs").cast("long").alias("n_runs"), first.alias("first"), F.array_join(lines, "").alias("lines"))
    length = -F.col("first.less")
    return rows.select(
        "doc_id",
        "n_runs",
        F.col("first.start").alias("start"),
        length.alias("length"),
        F.col("first.period").alias("period"),
        F.floor(1000 * length / F.col("first.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
