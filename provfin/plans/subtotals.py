"""Reported subtotals against the lines below them.

The dimension says which lines make up which subtotal. Recursive SQL follows it down to the lines that have no parts, so a subtotal is
held both against its direct parts and against all leaves under it, which tells where in the tree a difference arises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions.expr import named
from provfin.operators.pivot import KEYS


def below(tree: DataFrame) -> DataFrame:
    """whole, part, sign, level of everything under each subtotal, by as many levels as there are; ``leaf`` marks parts without parts.

    ``tree`` has whole, part, sign. A line may belong to several subtotals; a loop in the tree stops the query.
    """
    return tree.sparkSession.sql(
        """
        WITH RECURSIVE under(whole, part, sign, level) AS (
          SELECT whole, part, sign, 1 FROM {tree}
          UNION ALL
          SELECT under.whole, t.part, under.sign * t.sign, under.level + 1 FROM under JOIN {tree} t ON t.whole = under.part)
        SELECT under.*, NOT EXISTS (SELECT 1 FROM {tree} t WHERE t.whole = under.part) AS leaf FROM under
        """,
        tree=tree,
    )


def reconcile(fact: DataFrame, tree: DataFrame, tolerance: int = 0) -> DataFrame:
    """One row per organisation-year and reported subtotal: its value, the sum of its direct parts and of its leaves, and the differences.

    ``status`` is ``balanced`` if both differences are within the tolerance, ``different`` if not, and ``no parts`` where no line
    below the subtotal is reported. A code counts once, with its largest value, as in the views.
    """
    links = below(tree)
    codes = sorted({code for row in tree.select("whole", "part").collect() for code in row})  # the dimension is small
    lines = fact.filter(F.col("sub_code").isin(codes)).groupBy(*KEYS, "sub_code")
    values = lines.agg(F.max(F.col("total_000s").cast("bigint")).alias("value"))
    own = tree.select(F.col("whole"), F.col("whole").alias("code"), F.lit(1).alias("sign"), F.lit(0).alias("level"), F.lit(False).alias("leaf")).distinct()
    roles = own.unionByName(links.withColumnRenamed("part", "code"))
    columns = {
        "reported_000s": "max(CASE WHEN level = 0 THEN value END)",
        "parts_000s": "sum(CASE WHEN level = 1 THEN sign * value END)",
        "leaves_000s": "sum(CASE WHEN leaf THEN sign * value END)",
        "part_count": "count_if(level = 1)",
        "leaf_count": "count_if(leaf)",
    }
    met = values.join(roles, values.sub_code == roles.code).groupBy(*KEYS, "whole").agg(*named(columns)).filter("reported_000s IS NOT NULL")
    return met.selectExpr(
        *KEYS, "whole AS sub_code", "reported_000s", "parts_000s", "leaves_000s", "part_count", "leaf_count",
        "reported_000s - parts_000s AS parts_difference_000s",
        "reported_000s - leaves_000s AS leaves_difference_000s",
        f"""CASE WHEN parts_000s IS NULL THEN 'no parts' WHEN abs(reported_000s - parts_000s) <= {int(tolerance)}
            AND abs(reported_000s - coalesce(leaves_000s, reported_000s)) <= {int(tolerance)} THEN 'balanced' ELSE 'different' END AS status""",
    )
