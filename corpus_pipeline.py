"""From documents to token files: quality rules, near-dedup, decontamination, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns a
DataFrame; it is written as Parquet and read again as the next stage's docs. All but the last keep
the columns of docs, whatever they are called, and give an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyloft.llm import decontaminate, mixing, quality, simhash, tokens
from keyloft.llm.common import Scratch, load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep: no null or empty text; equal rows share their fate."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id.

    Null ids come last, ids that repeat don't join groups, of equal rows one stays.
    """
    return simhash.keep_one(docs, by="root")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage occurs in; a text without words has none. Equal rows share their fate."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, 0 to 3 times; a null source is a source."""
    return mixing.emit(docs)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file's documents, as read back, in the order of doc_id, null ids last."""
    return tokens.tokenize(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_file", token_file),
]

#: SQL can't express SimHash components or the tokenizer; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents."""
    scratch = Scratch(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
