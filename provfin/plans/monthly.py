"""KPIs of monthly returns: actuals against budgets, savings, agency staff and capital.

Input rows: org_code, financial_year, period (M01 to M12), account_type (INCOME, PAY, NON_PAY, CAPITAL, CIP),
subjective_code, data_type (ACTUAL, BUDGET) and amount_000s. Each KPI is one aggregation of them.
Percentages are rounded for display alone: statuses compare whole numbers, so 99.96 % of a target is not the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.refdata import AGENCY_CEILING_PCT, CAPITAL_RAG, CIP_RAG, VARIANCE_AMBER_PCT

YEAR_KEYS = ["org_code", "financial_year"]
MONTH_KEYS = [*YEAR_KEYS, "account_type", "period"]


def _sum(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN amount_000s END)"


def _side(data_type: str) -> str:
    return _sum(f"data_type = '{data_type}'")


def _share_at_least(part: str, whole: str, percent) -> str:
    """Whether part / whole is at least so many percent, without rounding; the whole is positive."""
    return f"CAST({part} AS DECIMAL(24,0)) * 100 >= CAST({percent} AS DECIMAL(6,2)) * {whole}"


def cip_achievement(rows: DataFrame, rag: tuple = CIP_RAG) -> DataFrame:
    """Savings delivered as % of target."""
    savings = rows.filter("account_type = 'CIP'")
    summed = expr.aggregate(savings, YEAR_KEYS, {"delivered_000s": _side("ACTUAL"), "target_000s": _side("BUDGET")})
    rated = summed.selectExpr("*", f"{expr.kpi('delivered_000s', 'target_000s', 100)} AS achieved")
    reached = [_share_at_least("delivered_000s", "target_000s", cut) for cut in rag]
    status = f"CASE WHEN achieved IS NULL THEN 'Grey' WHEN {reached[0]} THEN 'Green' WHEN {reached[1]} THEN 'Amber' ELSE 'Red' END"
    return rated.selectExpr(*summed.columns, f"{expr.double('achieved')} AS cip_achievement_pct", f"{status} AS cip_rag")


def agency_share(rows: DataFrame, ceiling: str = AGENCY_CEILING_PCT) -> DataFrame:
    """Agency cost as % of pay including agency; agency lines sit outside pay."""
    actual = rows.filter("data_type = 'ACTUAL' AND (account_type = 'PAY' OR subjective_code = 'AGENCY')")
    columns = {
        "pay_000s": f"coalesce({_sum('''subjective_code <> 'AGENCY' ''')}, 0)",
        "agency_000s": f"coalesce({_sum('''subjective_code = 'AGENCY' ''')}, 0)",
    }
    share = expr.kpi("agency_000s", "(pay_000s + agency_000s)", 100)
    return (
        expr.aggregate(actual, YEAR_KEYS, columns)
        .selectExpr("*", f"{share} AS share")
        .selectExpr(
            *YEAR_KEYS, "pay_000s", "agency_000s", f"{expr.double('share')} AS agency_pct",
            f"{expr.flag('share IS NOT NULL AND ' + _share_at_least('agency_000s', '(pay_000s + agency_000s)', ceiling))} AS over_ceiling",
        )
    )


def capital_share(rows: DataFrame, rag: tuple = CAPITAL_RAG) -> DataFrame:
    """Capital spend as % of plan; too much is as bad as too little."""
    amber, green, over = rag
    spend = rows.filter("account_type = 'CAPITAL'")
    summed = expr.aggregate(spend, YEAR_KEYS, {"actual_000s": _side("ACTUAL"), "plan_000s": _side("BUDGET")})
    rated = summed.selectExpr("*", f"{expr.kpi('actual_000s', 'plan_000s', 100)} AS share")
    reached = lambda cut: _share_at_least("actual_000s", "plan_000s", cut)
    status = (
        f"CASE WHEN share IS NULL THEN 'Grey' WHEN CAST(actual_000s AS DECIMAL(24,0)) * 100 > CAST({over} AS DECIMAL(6,2)) * plan_000s "
        f"OR NOT {reached(amber)} THEN 'Red' WHEN NOT {reached(green)} THEN 'Amber' ELSE 'Green' END"
    )
    return rated.selectExpr(*summed.columns, f"{expr.double('share')} AS capital_pct", f"{status} AS capital_rag")


def budget_variance(rows: DataFrame, amber: int = VARIANCE_AMBER_PCT) -> DataFrame:
    """Actual against budget by month and year to date, for income, pay and non-pay.

    The running window holds the twelve months of one organisation's year and account type. A positive
    variance is favourable for income and adverse for cost.
    """
    ledger = rows.filter("account_type IN ('INCOME', 'PAY', 'NON_PAY')")
    columns = {"actual_000s": f"coalesce({_side('ACTUAL')}, 0)", "budget_000s": f"coalesce({_side('BUDGET')}, 0)"}
    to_date = (
        Window.partitionBy(*MONTH_KEYS[:-1]).orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    months = expr.aggregate(ledger, MONTH_KEYS, columns).withColumns(
        {"ytd_actual_000s": F.sum("actual_000s").over(to_date), "ytd_budget_000s": F.sum("budget_000s").over(to_date)}
    )
    varied = months.selectExpr(
        "*",
        "actual_000s - budget_000s AS variance_000s",
        f"{expr.kpi('(actual_000s - budget_000s)', 'abs(budget_000s)', 100)} AS pct",
        "CASE WHEN account_type = 'INCOME' THEN 1 ELSE -1 END AS good",
    )
    return varied.selectExpr(
        *MONTH_KEYS,
        "actual_000s",
        "budget_000s",
        "variance_000s",
        f"{expr.double('pct')} AS variance_pct",
        "CASE WHEN variance_000s * good >= 0 THEN 'FAV' ELSE 'ADV' END AS direction",
        f"""CASE WHEN pct IS NULL THEN 'Grey' WHEN variance_000s * good >= 0 THEN 'Green'
            WHEN variance_000s * good * 100 >= -{amber} * abs(budget_000s) THEN 'Amber' ELSE 'Red' END AS variance_rag""",
        "ytd_actual_000s",
        "ytd_budget_000s",
        "ytd_actual_000s - ytd_budget_000s AS ytd_variance_000s",
    )
