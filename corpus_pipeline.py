"""The corpus pipeline: five stages from raw documents to token ids.

Defined cases, in all stages: an empty table stays empty; null and empty texts are clean and have
no tokens; rows without an id are kept by all stages but the mix, which treats their id as the text
`null`; rows that repeat an id have one fate in near_dedup and in the mix; columns besides those of
documents pass through all stages but the last. What a stage does with long texts and ties its
operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bpe_ranks, line_templates, poisson_mix, simhash, toxic_crf
from salesmart.llm.common import empty, noted, stored, table
from salesmart.llm.queries import tokenizer_path, toxic_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not predict toxic."""
    return toxic_crf.clean(docs, toxic_model(spark, docs, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template an earlier document has."""
    left = line_templates.deduplicated(docs, with_counts=False)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates: the one with the smallest id."""
    return simhash.one_of_each(docs).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources get the same expected number of rows, shuffled."""
    return poisson_mix.mixed(docs, with_draw=False)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and decoded text."""
    columns = docs.select("doc_id", "lang", "source", "text")
    return bpe_ranks.encode_documents(columns, tokenizer_path(), with_ids=True, without=["text"])


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

# No stage can be told in SQL as a whole: a trained tagger, XXH64 and BPE have no SQL functions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; what a stage returns is written and read again by the next.

    Once it is written, what the stage stored on the way and the table that it read are emptied, so
    that one copy of the corpus is left at the end. A stage that fails leaves both.
    """
    docs, read = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noted() as paths:
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        *own, result = paths
        empty(spark, [*own, *read])
        read = [result]
    return STAGES[-1][1](spark, docs, sf_dir)
