"""Awkward inputs that every operator has to take: nulls, empty and long texts, ties, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, size string, key string, node long, bucket long, n int, a int, copies int, label string"
)


def odd_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("the", "lan", "mer", "sol", "été", "Über") for b in ("a", "on", "ix", "'s", "ed.", "")]
    long_ = " ".join(rng.choice(words) for _ in range(20_000))
    copy = " ".join(rng.choice(words) for _ in range(200))
    near = copy.replace("lanon", "other", 1)
    rows = [
        (0, None, "en", "s1"),
        (1, "", "en", None),
        (2, " \n\t ", None, "s2"),
        (3, long_, "fr", "s1"),
        (4, copy, "en", "s1"),
        (5, copy, "en", "s2"),
        (6, near, "en", "s2"),
        (6, near, "en", "s2"),
        (None, copy, "en", "s3"),
        (None, None, None, None),
        (7, "x" * 5_000, "en", "s1"),
        (8, "one two", "en", "s1"),
        (9, "one two", "en", "s1"),
        (-3, "日本語 <|endoftext|> don't    İstanbul 12½ é", "fr", "é"),
        (10, "12 345 !!", "fr", "é"),
    ]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), rng.choice(["en", "fr"]), f"s{i % 4}") for i in range(40)]
    return rows


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    filled = [(*r, None if r[1] is None else len(r[1]), 7, "size", "key", 1, 2, 3, 4, 5, "label") for r in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


def odd_documents(spark: SparkSession) -> DataFrame:
    return frame(spark, odd_rows())


def text_of(row: tuple) -> str:
    return row[1] or ""
