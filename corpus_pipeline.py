"""From raw documents to training sequences: five stages, each written as Parquet and read by the next.

Each stage works on all documents that the one before it kept, and all but the last return the columns of the
documents. Results go to the folder that the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import decontaminate, language_id, line_dedup, packing, simhash
from eventlake.llm.common import scratch, stored, table
from eventlake.llm.queries import tokenizer_path
from eventlake.llm.shipping import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or that no learned language explains, go."""
    return language_id.with_language(docs)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later copies of repeated line runs are cut out; a document made of nothing else goes."""
    return line_dedup.without_copies(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each class the document with the smallest id stays.

    Links are neighbours in the SimHash trie and, beyond its budget of bits, texts that share rare shingles; each is
    checked for a similarity of 0.8 on sets of five-word shingles.
    """
    return simhash.one_of_each(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: contaminated documents go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of the documents that are left, with their sequences."""
    return packing.pieces(docs, tokenizer_path())


def _shipped(stage: Stage) -> Stage:
    """The stage, after the executors have the package."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _shipped(known_language)),
    ("line_dedup", _shipped(distinct_lines)),
    ("simhash_near_dedup", _shipped(distinct_documents)),
    ("decontamination", _shipped(clean_of_benchmarks)),
    ("packing", _shipped(sequences)),
]

#: Language models and tokenizers are not SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
