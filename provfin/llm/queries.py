"""One query for each corpus operator: it reads its whole table and returns the operator's digest of every row."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from provfin.llm import alignment, chat, decontaminate, html, importance, language, licenses, linededup, orderminhash, packing, simhash, substrings, toxicity

Query = Callable[[SparkSession, str], DataFrame]


#: Rows of an Arrow batch, as texts are long: Spark's own 10,000 would be some 100 MB in a worker.
BATCH_ROWS = 1000


def ready(spark: SparkSession) -> None:
    """Small Arrow batches; and workers that this session starts from now on also look for modules where this package lies."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    home = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, home]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file; by default the one that packing uses."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.report(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, {trap} AS text UNION ALL SELECT -1L, 1L, 'assistant', {trap}")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.formatted(turns.unionByName(extra)))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from provfin.llm import statements

    return statements.SQL
