"""From raw documents to token ids: quality rules, near-duplicates, repeated
strings, the mixture of sources, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; its result is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ferret.llm import bpe, minhash, mixing, quality, suffix
from ferret.llm.common import stored
from ferret.sources.tables import table

MIX_BLOCK = 64
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule of the policy go."""
    return quality.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 the smallest doc_id stays."""
    return minhash.keep_one(docs, size=5, percent=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose each string of 100 bytes that starts earlier too."""
    return suffix.cut(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in the order of a mixture to the weights of ``mixing.WEIGHTS``."""
    return mixing.mixed(docs, weights=mixing.WEIGHTS, block=MIX_BLOCK)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids and back; digests of both instead of the text, and
    the row's place in the mixture, which its predecessor left in the files."""
    return bpe.digests(mixing.placed(docs, "mix_position"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
          ("mix_sources", mix_sources), ("encode_texts", encode_texts)]

# Components of links, induced repeats and BPE merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
