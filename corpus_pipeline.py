"""A training corpus from raw documents, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestat.llm import chunks, decontaminate, neardup, packing, toxicity
from lodestat.llm.common import read
from lodestat.session import scratch_tables, settle_outside


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage model rejects go; it learns from the labelled ones among them."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return chunks.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by four fifths of their five-word shingles, one stays."""
    return neardup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("packing", pack)]

#: SQL cannot express the first and the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written before the next stage reads it, and what a stage kept on the way is removed."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch_tables(spark):
            docs = settle_outside(stage(spark, docs, sf_dir))
    return docs
