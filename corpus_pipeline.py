"""From raw documents to packed training windows.

Five stages, each an operator of ``verdant.llm``: the quality classifier
drops what it rejects, exact dedup and the n-gram Jaccard join leave one
document of each group, mixing repeats small sources up to their weight, and
packing cuts the rest into windows. Every stage reads all that the one
before it kept, as Parquet, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdant.llm import cuckoo, mixing, ngram_join, packing, quality
from verdant.llm.common import written
from verdant.llm.queries import TOKENIZER
from verdant.sources.tables import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` that the classifier accepts; labels come from ``sf_dir``."""
    return quality.stage_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest doc_id."""
    return cuckoo.stage_exact_dedup(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id."""
    return ngram_join.stage_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more, as often as its source's weight asks for."""
    return mixing.stage_mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.op3_packing(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_windows),
]

#: SQL can't express compression by dictionary, shingle components or packing;
#: tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
