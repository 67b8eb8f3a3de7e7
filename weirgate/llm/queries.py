"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import cover_dedup, decontamination, merkle, mixing, periodic_runs, substring_dedup
from weirgate.llm.common import WORD, table
from weirgate.llm.language_id import identify
from weirgate.llm.language_model import lm_scores
from weirgate.llm.near_dedup import near_classes
from weirgate.llm.quality import quality_scores
from weirgate.llm.token_counts import token_counts
from weirgate.llm.token_output import token_output
from weirgate.llm.vector_dedup import vector_classes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    # The contract's rows need no texts: sizes are counted at the scan, and only they move.
    mixed = mixing.mix(docs.select("doc_id", "source", words.alias("size"), F.xxhash64("text").alias("text_hash")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.repeated_spans(table(spark, sf_dir, "documents")))


@query("op4_token_output")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_embedding_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_classes(table(spark, sf_dir, "embeddings"))


@query("op8_lm_scores")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query("op10_decontamination", decontamination.SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


@query("op11_merkle_manifest", merkle.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(merkle.tampered(table(spark, sf_dir, "documents")))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


@query("op13_cover_dedup", cover_dedup.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_dedup.digest(cover_dedup.repeated_words(table(spark, sf_dir, "documents")))
