"""From raw documents to token files: each stage works on all that the one before it kept.

Language identification drops documents without a recognisable language. MinHash near-dedup keeps
one document of each class, the one with the smallest id. Decontamination drops documents that hold
a benchmark window. Mixing takes whole documents, some of them twice, so that each source's words
meet its target. The last stage writes the token ids as ORC files in order of ``doc_id`` and returns
their index, one row for each document taken.

No stage changes a text, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weirgate.llm.common import prepare, table
from weirgate.llm.decontamination import decontaminate
from weirgate.llm.language_id import keep_identified
from weirgate.llm.mixing import take
from weirgate.llm.near_dedup import drop_near_copies
from weirgate.llm.token_output import token_output
from weirgate.session import cut_lineage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return keep_identified(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_output(docs)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", tokens),
]

#: SQL has neither fitted language models nor weighted MinHash, cube sampling or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
