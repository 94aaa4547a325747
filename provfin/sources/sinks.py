"""Writers: partition-wise replacement for tables, CSV or Parquet for extracts and reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from provfin.functions.expr import scale_of
from provfin.functions.session import materialise
from provfin.operators.ingest import REFUSALS, flagged_lines
from provfin.operators.merge import build_dim_trust, merge_facts

PARTITIONS = ["financial_year", "trust_type"]


def replace_partitions(df: DataFrame, path: str) -> None:
    """Replaces the (financial year, trust type) partitions present in ``df``; others stay. Repeatable.

    The rebalance hint lets AQE split a large year over many tasks and gather small ones.
    """
    (
        df.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, None if nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def promote_into(path: str, incoming: DataFrame, years: list[str] | None = None) -> None:
    """Upserts fact rows into the table at ``path``; ``load_ts`` says when a key was first loaded.

    Only the incoming years' partitions are read and rewritten. A caller who knows the years, from the file names say,
    passes them; otherwise ``incoming`` is written to the shared folder first and its years are read from there, so the
    load runs once. The merged rows are materialised too, because Spark cannot overwrite what it is reading.
    """
    spark = incoming.sparkSession
    incoming = incoming.withColumn("load_ts", F.current_timestamp())
    existing = read_table(spark, path)
    if existing is None:
        replace_partitions(incoming, path)
        return
    kept, given = (scale_of(side, "total_000s") for side in (existing, incoming))
    if kept != given:
        raise ValueError(f"totals of the table keep {kept} fractional digits, those of the load {given}")
    if years is None:
        incoming = materialise(incoming)
        years = [row[0] for row in incoming.select("financial_year").distinct().collect()]
    touched = existing.filter(F.col("financial_year").isin(years))
    replace_partitions(materialise(merge_facts(touched, incoming)), path)


def upsert_trusts(path: str, providers: DataFrame, now: str = "current_timestamp()") -> None:
    """Brings the organisation dimension at ``path`` up to date; ``updated_ts`` is when a row last came to be or changed (``now``: SQL text).

    Repeating an upsert changes no row and so no time.
    """
    spark = providers.sparkSession
    existing = read_table(spark, path)
    merged = build_dim_trust(providers, existing)
    if existing is None:
        merged.withColumn("updated_ts", F.expr(now)).write.mode("overwrite").parquet(path)
        return
    values = [c for c in merged.columns if c != "org_code"]
    before = existing.select("org_code", F.struct(*values).alias("before"), F.col("updated_ts").alias("known_ts"))
    stamped = merged.join(before, "org_code", "left").withColumn(
        "updated_ts", F.when(F.struct(*values).eqNullSafe(F.col("before")), F.col("known_ts")).otherwise(F.expr(now))
    )
    materialise(stamped.drop("before", "known_ts")).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int = 16, key: str = "org_code") -> DataFrame:
    """Writes a table laid out by ``key``: rows of a key lie in one of ``buckets`` buckets, sorted. Tables of as many buckets meet without a shuffle.

    The rows are shuffled once, here, so that each bucket is one file; every later join on the key reads them where they lie.
    """
    laid = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    laid.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def stage_lines(raw: DataFrame, path: str) -> dict[str, int]:
    """Writes published lines below ``path``, kept ones (``refused=false``) apart from refused ones with their reasons.

    One scan does both and counts on the way what it reads, refuses, and refuses for which reason; the counts are returned.
    """
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("read"), F.count_if("refused").alias("refused")]
    counts += [F.count_if(F.array_contains("reasons", reason)).alias(reason) for reason in REFUSALS]
    lines = flagged_lines(raw).withColumn("refused", F.expr("size(reasons) > 0"))
    lines.observe(seen, *counts).write.mode("overwrite").partitionBy("refused").parquet(path)
    return seen.get


def write_extract(df: DataFrame, path: str, order: list[str] | None = None, single_file: bool = False) -> None:
    """CSV with a header. A row order holds across files by name; ``single_file`` is for small extracts."""
    ordered = df.orderBy(*order) if order else df
    out = ordered.coalesce(1) if single_file else ordered
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_extracts(frames: dict[str, DataFrame], folder: str, order: dict[str, list[str]], default: list[str]) -> None:
    """One folder per dataset, rows in their order."""
    for name, df in frames.items():
        write_extract(df, f"{folder}/{name}", order.get(name, default))


def write_report(report: DataFrame, path: str) -> None:
    """Check results with the time of the run."""
    stamped = report.withColumn("run_ts", F.current_timestamp())
    stamped.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
