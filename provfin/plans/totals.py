"""Base quantities of the measures under a filter context, from the scorecard or from a cube of it.

The cube holds the sums of every combination of the four slicers, and, because counts of different organisations cannot be added
up, a bitmap of the organisations of each combination: organisations are numbered once, a bitmap covers a bucket of numbers, and
bitmaps of several cells are merged by OR. A selection is answered from the combination that has its axes and slicers, whose size
depends on the number of slices, not on the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions.expr import named
from provfin.functions.session import materialise

AXES = ["financial_year", "sector", "trust_type", "region"]

# Base quantity: scorecard column.
SUMS = {
    "income": "total_income_000s",
    "patient_income": "patient_care_income_000s",
    "other_income": "other_income_000s",
    "expenditure": "total_expenditure_000s",
    "operating_surplus": "operating_surplus_000s",
    "net_surplus": "net_surplus_000s",
    "pay": "pay_000s",
    "non_pay": "non_pay_000s",
    "depreciation": "depreciation_amort_000s",
    "drugs": "drugs_cost_000s",
    "negligence": "clinical_negligence_000s",
    "ebitda": "ebitda_000s",
    "wte": "total_wte",
    "staff_cost": "total_staff_cost_000s",
    "medical": "medical_wte",
    "nursing": "nursing_wte",
}
COUNTS = {
    "deficit_trusts": "count_if(operating_surplus_000s < 0)",
    "surplus_trusts": "count_if(operating_surplus_000s >= 0)",
}


def select_context(card: DataFrame, filters: dict[str, list[str]] | None = None) -> DataFrame:
    """Slicers: a column and the values to keep."""
    for column, values in (filters or {}).items():
        card = card.filter(F.col(column).isin(*values))
    return card


def totals(card: DataFrame, by: list[str], filters: dict[str, list[str]] | None = None) -> DataFrame:
    """The base quantities of a selection along the axes; ``card`` is the scorecard, or a cube of it, which answers for its own axes alone."""
    if {"level", "trusts"} <= set(card.columns):
        return _from_cube(card, by, filters)
    columns = {name: f"sum({column})" for name, column in SUMS.items()} | COUNTS
    columns |= {"total_trusts": "count(DISTINCT org_code)"}
    return select_context(card, filters).groupBy(*by).agg(*named(columns))


def numbered(dim_trust: DataFrame) -> DataFrame:
    """org_code and a number of its own for every organisation; written, so that all readers see the same numbers."""
    return materialise(dim_trust.select("org_code").distinct().withColumn("org_number", F.monotonically_increasing_id() + 1))


def cells(card: DataFrame, numbers: DataFrame) -> DataFrame:
    """The finest cells: sums, and a bitmap of the organisations, by the four slicers and the bucket of the organisation's number."""
    columns = {name: f"sum({column})" for name, column in SUMS.items()} | COUNTS
    columns |= {"trusts": "bitmap_construct_agg(bitmap_bit_position(org_number))"}
    rows = card.join(numbers, "org_code").withColumn("bucket", F.expr("bitmap_bucket_number(org_number)"))
    return rows.groupBy(*AXES, "bucket").agg(*named(columns))


def cube(finest: DataFrame) -> DataFrame:
    """All sixteen combinations of the slicers from the finest cells. ``level`` tells which axes are rolled up, one bit each, the year's the highest."""
    sums = ", ".join(f"sum({name}) AS {name}" for name in (*SUMS, *COUNTS))
    axes = ", ".join(AXES)
    return finest.sparkSession.sql(
        f"SELECT {axes}, bucket, grouping_id() AS level, {sums}, bitmap_or_agg(trusts) AS trusts FROM {{finest}} GROUP BY bucket, CUBE ({axes})",
        finest=finest,
    )


def level_of(axes: set[str]) -> int:
    """The level at which exactly these axes are told apart."""
    return sum(1 << (len(AXES) - 1 - i) for i, axis in enumerate(AXES) if axis not in axes)


def _from_cube(made: DataFrame, by: list[str], filters: dict[str, list[str]] | None) -> DataFrame:
    wanted = {*by, *(filters or {})}
    if not wanted <= set(AXES):
        raise ValueError(f"the cube has {AXES}, not {sorted(wanted - set(AXES))}")
    rows = select_context(made.filter(F.col("level") == level_of(wanted)), filters)
    sums = {name: f"sum({name})" for name in SUMS} | {name: f"coalesce(sum({name}), 0)" for name in COUNTS}
    merged = rows.groupBy(*by, "bucket").agg(*named(sums | {"trusts": "bitmap_or_agg(trusts)"}))
    return merged.groupBy(*by).agg(*named(sums | {"total_trusts": "coalesce(sum(bitmap_count(trusts)), 0)"}))


def every_slice(made: DataFrame) -> DataFrame:
    """The cube for reading: one row per slice of every combination, with its sums and its number of different organisations."""
    sums = {name: f"sum({name})" for name in (*SUMS, *COUNTS)} | {"total_trusts": "sum(bitmap_count(trusts))"}
    return made.groupBy(*AXES, "level").agg(*named(sums)).withColumn("level", F.col("level").cast("bigint"))


def trusts_by_slice(made: DataFrame) -> DataFrame:
    """How many different organisations each slice of every combination has, from the bitmaps alone."""
    return made.groupBy(*AXES, "level").agg(F.expr("sum(bitmap_count(trusts)) AS trust_count")).withColumn("level", F.col("level").cast("bigint"))
