"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing,
token files.  Each stage works on what the stage before it kept; every result is
written as Parquet to the shared folder and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trolley.llm import decontam, mixing, rules, simhash, tokens
from trolley.llm.common import cut_lineage, read_table
from trolley.llm.queries import MIX_WEIGHTS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: that whose doc_id is the class id."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay, go or are repeated so that the languages' token totals meet the weights."""
    labelled = mixing.labelled_languages(docs, read_table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, MIX_WEIGHTS)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of what is left: doc_id, start, n_tokens, ids_crc32, read back from the files."""
    return tokens.token_output(docs, "byte_bpe_50k.json")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("token-ID output", tokenised),
]

#: SimHash classes and token ids are beyond SQL; tests hold each stage against its operator, run() by its row count
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
