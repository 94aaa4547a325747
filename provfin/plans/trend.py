"""Sector trend reports over the annual scorecard.

Years and row counts are parameters. All reports reduce the scorecard by a few low-cardinality keys, so
partial sums leave a handful of rows per task. Totals are rounded numbers (£m / £bn), not display text.
The scorecard has one row per organisation and year, so counting rows of a year counts organisations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.functions.expr import named
from provfin.operators.ranking import top_ranked

MILLION, BILLION = 1_000, 1_000_000
DEFICITS = "CAST(sum(is_deficit) AS BIGINT)"
STATUS = "CASE WHEN is_deficit = 1 THEN 'DEFICIT' ELSE 'SURPLUS' END"


def total_m(column: str, digits: int = 0) -> str:
    return expr.scaled(f"sum({column})", MILLION, digits)


def total_bn(column: str, digits: int = 1) -> str:
    return expr.scaled(f"sum({column})", BILLION, digits)


def in_year(card: DataFrame, year: str) -> DataFrame:
    return card.filter(F.col("financial_year") == year)


def national_trend(card: DataFrame) -> DataFrame:
    columns = {
        "total_income_bn": total_bn("total_income_000s"),
        "total_expenditure_bn": total_bn("total_expenditure_000s"),
        "op_surplus_m": total_m("operating_surplus_000s"),
        "net_surplus_m": total_m("net_surplus_000s"),
        "avg_ebitda_pct": expr.mean("ebitda_margin_pct"),
        "deficit_trusts": DEFICITS,
        "total_trusts": "count(*)",
    }
    return card.groupBy("financial_year").agg(*named(columns)).orderBy("financial_year")


def sector_kpis(card: DataFrame, year: str) -> DataFrame:
    columns = {
        "providers": "count(*)",
        "total_income_m": total_m("total_income_000s"),
        "avg_ebitda_pct": expr.mean("ebitda_margin_pct"),
        "avg_pay_pct": expr.mean("pay_pct_income"),
        "avg_net_surplus_pct": expr.mean("net_surplus_margin_pct"),
        "deficit_count": DEFICITS,
        "total_deficit_m": total_m("CASE WHEN operating_surplus_000s < 0 THEN operating_surplus_000s ELSE 0 END"),
    }
    return (
        in_year(card, year).groupBy("sector", "trust_type").agg(*named(columns)).orderBy("sector", "trust_type")
    )


def regional_growth(card: DataFrame, base: str, prior: str, year: str) -> DataFrame:
    """Income of three years by region; each year's sum is conditional, in one aggregation."""

    def income(y: str) -> str:
        return f"sum(CASE WHEN financial_year = '{y}' THEN total_income_000s END)"

    columns = {
        "income_base_000s": income(base),
        "income_prior_000s": income(prior),
        "income_current_000s": income(year),
    }
    growth = expr.pct("(income_current_000s - income_base_000s)", "income_base_000s")
    return (
        card.filter(F.col("region").isNotNull() & F.col("financial_year").isin(base, prior, year))
        .groupBy("region")
        .agg(*named(columns))
        .selectExpr("*", f"{growth} AS growth_2yr_pct")
        .orderBy(F.desc("income_current_000s"), "region")
    )


def ebitda_distribution(card: DataFrame, year: str) -> DataFrame:
    """Margin spread by sector; a margin of exactly 2 counts in both middle buckets."""
    columns = {
        "min_ebitda_pct": expr.double("min(ebitda_margin_pct)"),
        "avg_ebitda_pct": expr.mean("ebitda_margin_pct"),
        "max_ebitda_pct": expr.double("max(ebitda_margin_pct)"),
        "negative_ebitda": "count_if(ebitda_margin_pct < 0)",
        "low_0_2": "count_if(ebitda_margin_pct BETWEEN 0 AND 2)",
        "mid_2_5": "count_if(ebitda_margin_pct BETWEEN 2 AND 5)",
        "high_gt5": "count_if(ebitda_margin_pct > 5)",
    }
    return (
        in_year(card, year)
        .filter("sector IS NOT NULL")
        .groupBy("sector")
        .agg(*named(columns))
        .orderBy(F.desc("avg_ebitda_pct"), "sector")
    )


def top_income(card: DataFrame, year: str, limit: int = 20) -> DataFrame:
    ranked = top_ranked(in_year(card, year), F.desc("total_income_000s"), "org_code", limit, "rank")
    return ranked.selectExpr(
        "rank",
        "org_code",
        "organisation_name",
        "sector",
        "region",
        f"{expr.scaled('total_income_000s', MILLION, 0)} AS income_m",
        f"{expr.scaled('operating_surplus_000s', MILLION, 0)} AS op_surplus_m",
        "CAST(ebitda_margin_pct AS DOUBLE) AS ebitda_margin",
        "CAST(pay_pct_income AS DOUBLE) AS pay_pct",
        f"{STATUS} AS status",
    )


def worst_net_margin(card: DataFrame, year: str, limit: int = 20) -> DataFrame:
    order = F.asc_nulls_first("net_surplus_margin_pct")
    ranked = top_ranked(in_year(card, year), order, "org_code", limit, "deficit_rank")
    return ranked.selectExpr(
        "deficit_rank",
        "org_code",
        "organisation_name",
        "sector",
        "region",
        "trust_type",
        f"{expr.scaled('total_income_000s', MILLION, 0)} AS income_m",
        f"{expr.scaled('net_surplus_000s', MILLION, 0)} AS net_surplus_m",
        "CAST(net_surplus_margin_pct AS DOUBLE) AS net_margin",
        "CAST(ebitda_margin_pct AS DOUBLE) AS ebitda_margin",
    )


def pay_trend(card: DataFrame) -> DataFrame:
    columns = {
        "avg_pay_pct": expr.mean("pay_pct_income"),
        "total_pay_bn": total_bn("pay_000s"),
        "total_income_bn": total_bn("total_income_000s"),
        "sector_pay_pct": expr.weighted_pct("pay_000s", "total_income_000s"),
    }
    return (
        card.filter("sector IS NOT NULL")
        .groupBy("financial_year", "sector")
        .agg(*named(columns))
        .orderBy("financial_year", "sector")
    )


def mean_share(num: str, den: str, digits: int) -> str:
    """Mean over organisations of num as a percentage of den; decimal, so it does not depend on the order of partitions."""
    return expr.mean(f"CAST({expr.quotient(num, den, 100)} AS DECIMAL(28,10))", digits)


def drugs_cost(card: DataFrame, sectors: tuple[str, ...] = ("Acute", "Specialist")) -> DataFrame:
    columns = {
        "total_drugs_m": total_m("drugs_cost_000s"),
        "drugs_pct_income": expr.weighted_pct("drugs_cost_000s", "total_income_000s"),
        "avg_drugs_pct": mean_share("drugs_cost_000s", "total_income_000s", 1),
    }
    return (
        card.filter(F.col("sector").isin(*sectors) & F.col("drugs_cost_000s").isNotNull())
        .groupBy("financial_year", "sector")
        .agg(*named(columns))
        .orderBy("financial_year", "sector")
    )


def negligence_national(card: DataFrame) -> DataFrame:
    columns = {
        "total_neg_m": total_m("clinical_negligence_000s"),
        "neg_pct_income": expr.weighted_pct("clinical_negligence_000s", "total_income_000s"),
        "trusts_reporting": "count(org_code)",
    }
    return (
        card.filter("clinical_negligence_000s IS NOT NULL")
        .groupBy("financial_year")
        .agg(*named(columns))
        .orderBy("financial_year")
    )


def finance_position(card: DataFrame) -> DataFrame:
    net = "(sum(finance_income_000s) - sum(finance_expense_000s) - sum(pdc_dividend_000s))"
    columns = {
        "finance_income_m": total_m("finance_income_000s"),
        "finance_expense_m": total_m("finance_expense_000s"),
        "pdc_dividend_m": total_m("pdc_dividend_000s"),
        "net_finance_m": expr.scaled(net, MILLION, 0),
    }
    return (
        card.filter("finance_income_000s IS NOT NULL")
        .groupBy("financial_year")
        .agg(*named(columns))
        .orderBy("financial_year")
    )
