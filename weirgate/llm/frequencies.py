"""Word frequencies of documents joined with figures of the distinct words.

Two tiers keep the shuffle small and safe. A dictionary of the most frequent words, bounded in
size by a count threshold, goes to the tasks, which settle those words where they read the text.
Only the rest, rare words by construction, travel as (word, row, frequency) to the join, so no
word's rows can pile up in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most words of the dictionary that goes to every task (some 20 MB in a worker).
DICTIONARY = 150_000


#: Distinct words a task holds before it hands them on.
HELD = 400_000


def word_counts(texts: DataFrame, words: Callable[[str], Iterable]) -> DataFrame:
    """``word`` and ``n`` over all texts: counted within each task, then combined by one shuffle."""

    def tally(column: pa.Array) -> Iterator[Iterable]:
        return (words(text) for text in column.to_pylist() if text is not None)

    return tallied(texts, tally)


def tallied(texts: DataFrame, tally: Callable[[pa.Array], Iterator[Mapping | Iterable]]) -> DataFrame:
    """``word`` and ``n`` over all texts; ``tally`` gives words or their counts, of some texts of a batch at a time."""
    kind = texts.schema["text"].dataType.simpleString()
    arrow = pa.binary() if kind == "binary" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), arrow), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for some in tally(batch.column("text")):
                total.update(some)
                if len(total) > HELD:
                    yield handed()
        yield handed()

    return texts.mapInArrow(run, f"word {kind}, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, at_most: int = DICTIONARY) -> DataFrame:
    """The words whose count is at or above the lowest threshold that keeps ``at_most`` of them.

    The histogram that finds the threshold has one row per distinct count, folded above 100,000
    into steps, so it stays small whatever the corpus.
    """
    step = F.when(F.col("n") < 100_000, F.col("n")).otherwise(
        F.expr("cast(100000 * pow(2, floor(log2(n / 100000.0))) as bigint)")
    )
    histogram = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    taken, threshold = 0, None
    for r in sorted(histogram, key=lambda r: -r["step"]):
        taken += r["words"]
        if taken > at_most:
            break
        threshold = r["step"]
    return counts.filter(F.col("n") >= threshold) if threshold is not None else counts.limit(0)
