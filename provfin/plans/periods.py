"""Reporting periods of dates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from provfin.functions import expr


def fiscal_period(df: DataFrame, date: str) -> DataFrame:
    """Adds financial year, month number, period and quarter of a date column."""
    return df.selectExpr(
        "*",
        f"{expr.financial_year(date)} AS financial_year",
        f"{expr.fiscal_month(date)} AS fiscal_month",
        f"{expr.period_label(date)} AS period_label",
        f"{expr.quarter_label(date)} AS quarter_label",
    )


def years_of(df: DataFrame, date: str) -> DataFrame:
    """Calendar rows of the financial years a date column falls in; complete once all twelve months occur.

    Dates are reduced to months first, so a busy year is at most twelve rows per task.
    """
    months = df.filter(f"{date} IS NOT NULL").selectExpr(
        f"{expr.fiscal_year_start(date)} AS start_year", f"{expr.fiscal_month(date)} AS month"
    )
    years = months.distinct().groupBy("start_year").count()
    return years.selectExpr(
        f"{expr.year_label('start_year')} AS financial_year",
        "make_date(start_year, 4, 1) AS start_date",
        "make_date(start_year + 1, 3, 31) AS end_date",
        f"substr({expr.year_label('start_year')}, 3, 5) AS year_label_short",
        f"{expr.flag('count = 12')} AS is_complete",
    )
