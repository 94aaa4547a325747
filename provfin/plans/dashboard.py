"""Datasets behind the report pages that no other plan already gives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.functions.expr import named
from provfin.plans.trend import MILLION, in_year, total_bn, total_m
from provfin.plans.views import HEAD

INCOME_M = f"{expr.scaled('total_income_000s', MILLION, 1)} AS total_income_m"


def _number(column: str) -> str:
    return f"CAST({column} AS DOUBLE) AS {column}"


def income_by_sector(card: DataFrame) -> DataFrame:
    columns = {
        "patient_income_m": total_m("patient_care_income_000s", 1),
        "other_income_m": total_m("other_income_000s", 1),
        "total_income_m": total_m("total_income_000s", 1),
    }
    return card.groupBy("financial_year", "sector").agg(*named(columns)).orderBy("financial_year", "sector")


def _steps(card: DataFrame, columns: dict[str, str], name: str, value: str) -> DataFrame:
    """Yearly aggregates as one row per year and name."""
    summed = card.groupBy("financial_year").agg(*named(columns))
    return summed.unpivot("financial_year", list(columns), name, value).orderBy("financial_year", name)


def deficit_surplus_split(card: DataFrame) -> DataFrame:
    columns = {
        "Deficit": "count_if(operating_surplus_000s < 0)",
        "Surplus": "count_if(operating_surplus_000s >= 0)",
    }
    return _steps(card, columns, "position", "trusts")


def income_bridge(card: DataFrame) -> DataFrame:
    """From income over expenditure to surplus; expenditure counts downwards."""
    columns = {
        "Income": total_m("total_income_000s", 1),
        "Expenditure": total_m("-total_expenditure_000s", 1),
        "Surplus": total_m("operating_surplus_000s", 1),
    }
    return _steps(card, columns, "step", "value_m")


def trust_year_matrix(income: DataFrame) -> DataFrame:
    return income.select(
        "org_code", "organisation_name", "financial_year", "total_income_000s", "total_expenditure_000s",
        "operating_surplus_000s",
    )


def ebitda_income_scatter(kpis: DataFrame) -> DataFrame:
    return kpis.selectExpr(*HEAD, _number("ebitda_margin_pct"), INCOME_M)


def pay_ebitda_scatter(kpis: DataFrame) -> DataFrame:
    return kpis.selectExpr(*HEAD, _number("pay_pct_income"), _number("ebitda_margin_pct"))


def spend_mix(card: DataFrame) -> DataFrame:
    columns = {
        "Pay": total_m("pay_000s", 1),
        "Non-pay": total_m("non_pay_000s", 1),
        "D&A": total_m("depreciation_amort_000s", 1),
    }
    return _steps(card, columns, "category", "value_m")


def wte_by_sector(card: DataFrame) -> DataFrame:
    return (
        card.groupBy("financial_year", "sector")
        .agg(*named({"total_wte": "sum(total_wte)"}))
        .orderBy("financial_year", "sector")
    )


def staff_cost_trend(card: DataFrame) -> DataFrame:
    columns = {
        "staff_cost_bn": total_bn("total_staff_cost_000s", 2),
        "total_wte": "sum(total_wte)",
        "cost_per_wte_000s": expr.ratio("sum(total_staff_cost_000s)", "sum(total_wte)"),
    }
    return card.groupBy("financial_year").agg(*named(columns)).orderBy("financial_year")


def best_ebitda(card: DataFrame, year: str, limit: int = 20) -> DataFrame:
    return (
        in_year(card, year)
        .orderBy(F.desc_nulls_last("ebitda_margin_pct"), "org_code")
        .limit(limit)
        .selectExpr(*HEAD, _number("ebitda_margin_pct"), INCOME_M)
    )


def cost_per_wte_by_trust(card: DataFrame, year: str) -> DataFrame:
    return in_year(card, year).selectExpr(*HEAD, "total_wte", "staff_cost_000s", _number("cost_per_wte_000s"))
