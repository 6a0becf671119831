"""The operators as registered queries over the given tables, with production
parameters; each derives the columns of its contract from its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trolley.llm import crf, substring, suffix, warc
from trolley.llm.align import alignments
from trolley.llm.common import read_table
from trolley.llm.decontam import contaminated
from trolley.llm.extract import extract
from trolley.llm.mixing import document_rates, labelled_languages
from trolley.llm.oracles import ORACLES
from trolley.llm.piecewise import edited_likeness
from trolley.llm.rules import quality_rules
from trolley.llm.setm import collocations
from trolley.llm.simhash import near_duplicates
from trolley.llm.tokens import token_output

__all__ = ["MIX_WEIGHTS", "ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


#: shares of tokens that the mix aims at, by language
MIX_WEIGHTS = {"en": 0.55, "fr": 0.17, "de": 0.17, "es": 0.11}


def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.remove_repeats(read_table(spark, sf_dir, "documents"), width=35))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("row_key")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read_table(spark, sf_dir, "pages"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.remove_repeats(read_table(spark, sf_dir, "documents"), length=200))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(read_table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op10_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return document_rates(docs, labelled_languages(docs, read_table(spark, sf_dir, "labels")), MIX_WEIGHTS)


def op11_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(read_table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(read_table(spark, sf_dir, "documents"), keep_groups=False).drop("groups")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


QUERIES |= {f.__name__: f for f in (
    op1_crf_quality, op2_substring_dedup, op3_template_decontamination, op4_simhash_near_dedup, op5_warc_index,
    op6_suffix_dedup, op7_token_output, op8_quality_rules, op9_main_text, op10_soft_mixing,
    op11_piecewise_fingerprints, op12_tokenizer_alignment, op13_collocations)}
