"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouping by minimum, which is combined before it is shuffled, and a join that Spark may split; no component is
ever gathered. Steps are written to the shared folder, so that lineage stays short and lost executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions.session import stored


def _star(pairs: DataFrame) -> DataFrame:
    """Both steps: each node's larger neighbours, then its smaller ones, are linked to the smallest node it knows."""
    both = pairs.unionByName(pairs.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least")).select(F.col("high").alias("node"), F.least("least", "high").alias("least"))
    large = both.where("low > high").join(least, F.col("high") == F.col("node"))
    large = large.select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()
    least = large.groupBy("high").agg(F.min("low").alias("least")).withColumnRenamed("high", "node")
    small = large.join(least, F.col("high") == F.col("node")).where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return small.unionByName(least.select(F.col("node").alias("high"), F.col("least").alias("low"))).distinct()


def _done(pairs: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none."""
    if not pairs.groupBy("high").count().where("count > 1").isEmpty():
        return False
    return pairs.join(pairs.select(F.col("high").alias("node")), F.col("low") == F.col("node"), "left_semi").isEmpty()


def roots(links: DataFrame) -> DataFrame:
    """node, root for every node with a link; the root is the smallest node that can be reached. links: two columns of numbers.

    Loops, repeated links and links with a null end do not matter; no links give no row.
    """
    a, b = (F.col(c) for c in links.columns[:2])
    pairs = stored(links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where(a.isNotNull() & b.isNotNull() & (a != b)).distinct())
    while not _done(pairs):
        pairs = stored(_star(pairs))
    low = pairs.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(low)
