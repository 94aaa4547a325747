"""The corpus pipeline: toxic documents go, near-duplicates, repeated passages and benchmark texts too, and what is left is packed.

Every stage reads all that the one before kept. Within ``run`` a stage's result is written to the shared folder and read again, as a
scheduler of separate jobs would do it, so a lost executor costs no more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from provfin.functions.session import stored
from provfin.llm import decontaminate, packing, simhash, substrings, toxicity
from provfin.llm.queries import ready, table, tokenizer_path


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that a model of the labels finds toxic."""
    ready(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ready(spark)
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of windows that stand elsewhere."""
    ready(spark)
    return substrings.remove(docs)


def benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents."""
    ready(spark)
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids, packed along the curve."""
    ready(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxic_documents),
    ("simhash_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_texts),
    ("packing", sequences),
]
#: No SQL can learn a model or encode texts; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
