"""Derived columns on the scorecard: sector labels, flags, income mix, margin movement, sector benchmarks.

Each step takes and returns a DataFrame, for use with ``DataFrame.transform``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.plans.benchmark import pay_threshold
from provfin.refdata import EBITDA_RAG, LARGE_INCOME_000S, PAY_AMBER_THRESHOLD, SECTOR_ALIASES


def normalise_sectors(df: DataFrame, aliases: dict[str, str] = SECTOR_ALIASES) -> DataFrame:
    """Known sector spellings to one label each; other values stay."""
    return df.withColumn("sector", F.expr(expr.lookup("sector", aliases, "sector")))


def trust_flags(
    card: DataFrame, large_income=LARGE_INCOME_000S, thresholds=PAY_AMBER_THRESHOLD, rag=EBITDA_RAG
) -> DataFrame:
    """Size flag, pay-pressure flag (an unknown sector has no threshold, hence no flag) and margin status."""
    return card.withColumns(
        {
            "is_large": F.expr(expr.flag(f"total_income_000s >= {large_income}")),
            "pay_pressure_flag": F.expr(expr.flag(f"pay_pct_income > {pay_threshold(thresholds, None)}")),
            "ebitda_rag": F.expr(expr.rag("ebitda_margin_pct", *rag)),
        }
    )


def income_mix(card: DataFrame) -> DataFrame:
    return card.selectExpr(
        "*",
        f"{expr.kpi_even('patient_care_income_000s', 'total_income_000s', 100)} AS patient_income_pct",
        f"{expr.kpi_even('other_income_000s', 'total_income_000s', 100)} AS other_income_pct",
    )


def yoy_ebitda(card: DataFrame) -> DataFrame:
    """Margin change against the organisation's previous row, which need not be the previous year.

    The window holds one organisation's years: at most as many rows as there are years.
    """
    history = Window.partitionBy("org_code").orderBy("financial_year")
    prior = card.withColumn("ebitda_margin_pct_prior_yr", F.lag("ebitda_margin_pct").over(history))
    change = f"CAST(ebitda_margin_pct - ebitda_margin_pct_prior_yr AS {expr.PCT})"
    return prior.selectExpr("*", f"{change} AS ebitda_margin_yoy_pp")


def enrich(card: DataFrame) -> DataFrame:
    return card.transform(normalise_sectors).transform(trust_flags).transform(income_mix).transform(yoy_ebitda)


def sector_benchmarks(card: DataFrame) -> DataFrame:
    """Year and sector summary with medians; rows without a sector are left out and empty sums are 0.

    The median is taken over whole tenths of a percent, so Spark's value-to-count state stays as small
    as the number of distinct margins, and partial states are merged across the shuffle.
    """

    def total(column: str) -> str:
        return f"coalesce(sum({column}), 0)"

    columns = {
        "providers": "count(org_code)",
        "total_income_000s": total("total_income_000s"),
        "total_expenditure_000s": total("total_expenditure_000s"),
        "total_surplus_000s": total("operating_surplus_000s"),
        "total_pay_000s": total("pay_000s"),
        "total_wte": total("total_wte"),
        "avg_ebitda_margin_pct": expr.mean_even("ebitda_margin_pct"),
        "median_ebitda_pct": "bround(median(CAST(ebitda_margin_pct * 10 AS BIGINT)), 0) / 10D",
        "avg_pay_pct_income": expr.mean_even("pay_pct_income"),
        "avg_cost_per_wte_000s": expr.mean_even("cost_per_wte_000s"),
        "deficit_trusts": "CAST(sum(is_deficit) AS BIGINT)",
    }
    weighted = f"CAST({expr.kpi_even('total_pay_000s', 'total_income_000s', 100)} AS DOUBLE)"
    return (
        card.filter("sector IS NOT NULL AND financial_year IS NOT NULL")
        .groupBy("financial_year", "sector")
        .agg(*expr.named(columns))
        .selectExpr("*", f"{weighted} AS sector_pay_pct")
    )
