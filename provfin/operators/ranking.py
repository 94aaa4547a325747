"""Ranking without putting all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provfin.functions.session import materialise


def top_ranked(df: DataFrame, order: Column, tiebreak: str, n: int, name: str) -> DataFrame:
    """First ``n`` rows with their tie-aware rank.

    The limit runs first: each task keeps only its own best ``n`` rows. A row's rank depends on the rows
    above it alone and all of those survive, so ranking the survivors gives the ranks of the whole.
    """
    best = df.orderBy(order, F.asc(tiebreak)).limit(n)
    return best.withColumn(name, F.rank().over(Window.orderBy(order)).cast("bigint"))


def positions(df: DataFrame, by: list[str], order: list[str], position: str, total: str) -> DataFrame:
    """Exact 1-based row position and row count within ``by``, for groups of any size.

    Rows are range-partitioned and sorted on (by, order), so even one huge group or one repeated value is spread over all
    partitions. A row's number carries its partition and its place in it; each partition's share of a group (one small row)
    says how many rows come before. The numbered rows are written out once: both readers must see the same numbers, also
    after an executor is lost. They are not shuffled again.
    """
    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    ranged = materialise(ranged.withColumn("_row", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_part", F.shiftright("_row", 33))
    shares = ranged.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_row").alias("_first"))
    group = Window.partitionBy(*by)
    before = shares.select(
        *by,
        "_part",
        (F.sum("_size").over(group.orderBy("_part")) - F.col("_size") - F.col("_first")).alias("_before"),
        F.sum("_size").over(group).alias(total),
    )
    return (
        ranged.join(before, [*by, "_part"])
        .withColumn(position, F.col("_before") + F.col("_row") + 1)
        .drop("_part", "_before", "_row")
    )


def ntile(df: DataFrame, n: int, by: list[str], order: list[str], name: str) -> DataFrame:
    """SQL ``NTILE(n)``: as even as possible, larger buckets first."""
    placed = positions(df, by, order, "_pos", "_total")
    small = F.floor(F.col("_total") / n)
    larger = F.col("_total") % n
    edge = larger * (small + 1)
    bucket = F.when(F.col("_pos") <= edge, F.ceil(F.col("_pos") / (small + 1))).otherwise(
        larger + F.ceil((F.col("_pos") - edge) / F.nullif(small, F.lit(0)))
    )
    return placed.withColumn(name, bucket.cast("bigint")).drop("_pos", "_total")
