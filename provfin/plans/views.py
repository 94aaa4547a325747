"""The five analytical views, each one row per organisation and financial year.

The organisation dimension is joined after the fact has been reduced to organisation-years, never to raw
lines, so the join is small and free of hot keys. No side is hinted: Spark broadcasts the dimension
only when its size is below the threshold, and hash-partitions both sides otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.operators.pivot import Category, Line, Present, pivot_lines
from provfin.refdata import EBITDA_RAG, SURPLUS_RAG, WS_EXPENDITURE, WS_SOCI, WS_STAFF

TRUST = ["org_code", "organisation_name", "sector", "region", "trust_type"]
HEAD = [*TRUST, "financial_year"]

INCOME_LINES = [
    Line("patient_care_income_000s", "SCI0100A", WS_SOCI),
    Line("other_income_000s", "SCI0110A", WS_SOCI),
    Line("expenses_signed", "SCI0125A", WS_SOCI),
    Line("operating_surplus_000s", "SCI0140A", WS_SOCI),
    Line("net_surplus_000s", "SCI0240", WS_SOCI),
]
EXPENDITURE_CATEGORIES = [
    Category("pay_000s", "PAY", WS_EXPENDITURE),
    Category("non_pay_000s", "NON_PAY", WS_EXPENDITURE),
    Category("depreciation_amort_000s", "NON_PAY_EXCL_EBITDA", WS_EXPENDITURE),
]
EXPENDITURE_LINES = [
    Line("staff_cost_000s", "EXP0130", WS_EXPENDITURE),
    Line("drugs_cost_000s", "EXP0170", WS_EXPENDITURE),
    Line("depreciation_000s", "EXP0240", WS_EXPENDITURE),
    Line("amortisation_000s", "EXP0250", WS_EXPENDITURE),
    Line("clinical_supplies_000s", "EXP0150", WS_EXPENDITURE),
    Line("general_supplies_000s", "EXP0160", WS_EXPENDITURE),
    Line("clinical_negligence_000s", "EXP0290A", WS_EXPENDITURE),
    Line("establishment_costs_000s", "EXP0200", WS_EXPENDITURE),
    Line("premises_rates_000s", "EXP0210", WS_EXPENDITURE),
    Line("premises_other_000s", "EXP0220", WS_EXPENDITURE),
    Line("total_expenditure_000s", "EXP0390", WS_EXPENDITURE),
]
WORKFORCE_LINES = [
    Line("total_staff_cost_000s", "STA0250", WS_STAFF),
    Line("gross_staff_cost_000s", "STA0220", WS_STAFF),
    Line("total_wte", "STA0410", WS_STAFF),
    Line("medical_wte", "STA0310", WS_STAFF),
    Line("nursing_wte", "STA0350", WS_STAFF),
    Line("admin_estates_wte", "STA0330", WS_STAFF),
    Line("healthcare_assistant_wte", "STA0340", WS_STAFF),
    Line("scientific_tech_wte", "STA0370", WS_STAFF),
    Line("total_days_lost_sickness", "STA0530", WS_STAFF),
    Line("avg_days_lost_per_wte", "STA0550", WS_STAFF),
]
# Lines the scorecard adds; it reads these sub-codes on any worksheet.
SCORECARD_LINES = [
    Line("api_variable_income_000s", "INC0197", None),
    Line("api_fixed_income_000s", "INC0198", None),
    Line("high_cost_drugs_income_000s", "INC0200", None),
    Line("private_patient_income_000s", "INC0330", None),
    Line("total_patient_income_tac06_000s", "INC0350", None),
    Line("rd_income_000s", "INC1230A", None),
    Line("education_training_income_000s", "INC1240A", None),
    Line("total_other_income_tac07_000s", "INC1360", None),
    Line("clinical_supplies_000s", "EXP0150", None),
    Line("general_supplies_000s", "EXP0160", None),
    Line("clinical_negligence_000s", "EXP0290A", None),
    Line("depreciation_000s", "EXP0240", None),
    Line("amortisation_000s", "EXP0250", None),
    Line("finance_income_000s", "SCI0150", None),
    Line("finance_expense_000s", "SCI0160", None),
    Line("pdc_dividend_000s", "SCI0170", None),
]


TOTAL_INCOME = "coalesce(patient_care_income_000s, 0) + coalesce(other_income_000s, 0)"
TOTAL_EXPENDITURE = "abs(coalesce(expenses_signed, 0))"
EBITDA = "operating_surplus_000s + coalesce(depreciation_amort_000s, 0)"


def with_trust(org_years: DataFrame, dim_trust: DataFrame) -> DataFrame:
    return org_years.join(dim_trust.select(*TRUST), "org_code")


def income_expenditure(fact: DataFrame, dim_trust: DataFrame) -> DataFrame:
    """Income, expenditure and surplus from the summary statement."""
    return _income_columns(pivot_lines(fact, INCOME_LINES, rows=f"worksheet_name = '{WS_SOCI}'"), dim_trust)


def _income_columns(rows: DataFrame, dim_trust: DataFrame) -> DataFrame:
    return with_trust(rows, dim_trust).selectExpr(
        *HEAD,
        "patient_care_income_000s",
        "other_income_000s",
        f"{TOTAL_INCOME} AS total_income_000s",
        f"{TOTAL_EXPENDITURE} AS total_expenditure_000s",
        "operating_surplus_000s",
        "net_surplus_000s",
    )


def expenditure_breakdown(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame) -> DataFrame:
    """Cost categories and single cost lines; lines with an unseeded code do not count."""
    columns = [*EXPENDITURE_CATEGORIES, *EXPENDITURE_LINES]
    rows = pivot_lines(fact, columns, dim_subcode, rows=f"worksheet_name = '{WS_EXPENDITURE}'", unseeded=False)
    return expr.select(with_trust(rows, dim_trust), *HEAD, *[c.name for c in columns])


def workforce(fact: DataFrame, dim_trust: DataFrame) -> DataFrame:
    """Staff cost, head count by group, and sickness."""
    rows = pivot_lines(fact, WORKFORCE_LINES, rows=f"worksheet_name = '{WS_STAFF}'")
    return expr.select(with_trust(rows, dim_trust), *HEAD, *[c.name for c in WORKFORCE_LINES])


def _with_kpis(rows: DataFrame) -> DataFrame:
    """KPI columns over pivoted organisation-years with income; the margins are NULL-safe.

    Where totals keep fractions, numerator and denominator are divided in units of the last digit, so nothing is rounded before.
    """
    scale = expr.scale_of(rows, "total_wte")
    kpi = lambda num, den, times=1: expr.kpi(*(f"{c} * {10**scale}" if scale else c for c in (num, den)), times)
    earning = rows.selectExpr(
        "*",
        f"{TOTAL_INCOME} AS total_income_000s",
        f"{TOTAL_EXPENDITURE} AS total_expenditure_000s",
        f"{EBITDA} AS ebitda_000s",
    ).filter("total_income_000s > 0")
    return earning.selectExpr(
        "*",
        f"{kpi('ebitda_000s', 'total_income_000s', 100)} AS ebitda_margin_pct",
        f"{kpi('pay_000s', 'total_income_000s', 100)} AS pay_pct_income",
        f"{kpi('staff_cost_000s', 'total_wte')} AS cost_per_wte_000s",
        f"{kpi('net_surplus_000s', 'total_income_000s', 100)} AS net_surplus_margin_pct",
        f"{expr.flag('operating_surplus_000s < 0')} AS is_deficit",
    )


KPI_COLUMNS = [
    *HEAD,
    "total_income_000s", "total_expenditure_000s", "operating_surplus_000s", "net_surplus_000s",
    "pay_000s", "non_pay_000s", "depreciation_amort_000s", "staff_cost_000s", "drugs_cost_000s",
    "clinical_negligence_000s",
    "total_wte", "medical_wte", "nursing_wte", "avg_days_lost_per_wte",
    "ebitda_000s", "ebitda_margin_pct", "pay_pct_income", "cost_per_wte_000s", "net_surplus_margin_pct",
    "is_deficit", "ebitda_rag", "surplus_rag",
]


def kpis(
    fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, ebitda_rag=EBITDA_RAG, surplus_rag=SURPLUS_RAG
) -> DataFrame:
    """KPIs of every organisation-year with income, from one pass over the fact.

    ``surplus_rag`` compares the unrounded margin, as whole numbers: net * 100 against cut * income.
    """
    columns = [*INCOME_LINES, *EXPENDITURE_CATEGORIES, *EXPENDITURE_LINES[:-1], *WORKFORCE_LINES]
    return _kpi_columns(pivot_lines(fact, columns, dim_subcode), dim_trust, ebitda_rag, surplus_rag)


def _kpi_columns(rows: DataFrame, dim_trust: DataFrame, ebitda_rag=EBITDA_RAG, surplus_rag=SURPLUS_RAG) -> DataFrame:
    cuts = [f"{cut} * total_income_000s" for cut in surplus_rag]
    rows = _with_kpis(rows).selectExpr(
        "*",
        f"{expr.rag('ebitda_margin_pct', *ebitda_rag)} AS ebitda_rag",
        f"{expr.rag('net_surplus_000s * 100', *cuts)} AS surplus_rag",
    )
    return expr.select(with_trust(rows, dim_trust), *KPI_COLUMNS)


def wide_rows(fact: DataFrame, dim_subcode: DataFrame) -> DataFrame:
    """What the four narrow views read, from one pass over the fact: a row per organisation-year with a line on any of their worksheets."""
    columns = [
        Present("on_income", WS_SOCI), Present("on_expenditure", WS_EXPENDITURE, seeded=True), Present("on_staff", WS_STAFF),
        *INCOME_LINES, *EXPENDITURE_CATEGORIES, *EXPENDITURE_LINES[:-1], *WORKFORCE_LINES,
        *[Line(f"listed_{c.name}", c.sub_code, c.worksheet, seeded=True) for c in EXPENDITURE_LINES],
    ]
    return pivot_lines(fact, columns, dim_subcode)


def narrow_views(wide: DataFrame, dim_trust: DataFrame) -> dict[str, DataFrame]:
    """The four views by name, from ``wide_rows``: what each is when it reads the fact itself."""
    spent = with_trust(wide.filter("on_expenditure = 1"), dim_trust)
    staff = with_trust(wide.filter("on_staff = 1"), dim_trust)
    listed = [f"listed_{c.name} AS {c.name}" for c in EXPENDITURE_LINES]
    return {
        "income_expenditure": _income_columns(wide.filter("on_income = 1"), dim_trust),
        "expenditure_breakdown": expr.select(spent, *HEAD, *[c.name for c in EXPENDITURE_CATEGORIES], *listed),
        "workforce": expr.select(staff, *HEAD, *[c.name for c in WORKFORCE_LINES]),
        "kpis": _kpi_columns(wide, dim_trust),
    }


SCORECARD_COLUMNS = [
    *HEAD,
    "total_income_000s", "patient_care_income_000s", "other_income_000s",
    "api_variable_income_000s", "api_fixed_income_000s", "high_cost_drugs_income_000s",
    "private_patient_income_000s", "total_patient_income_tac06_000s",
    "rd_income_000s", "education_training_income_000s", "total_other_income_tac07_000s",
    "total_expenditure_000s", "pay_000s", "non_pay_000s", "depreciation_amort_000s",
    "drugs_cost_000s", "staff_cost_000s",
    "clinical_supplies_000s", "general_supplies_000s", "clinical_negligence_000s",
    "depreciation_000s", "amortisation_000s",
    "operating_surplus_000s", "net_surplus_000s", "ebitda_000s",
    "finance_income_000s", "finance_expense_000s", "pdc_dividend_000s",
    "total_wte", "medical_wte", "nursing_wte", "avg_days_lost_per_wte",
    "total_staff_cost_000s", "gross_staff_cost_000s",
    "ebitda_margin_pct", "pay_pct_income", "cost_per_wte_000s", "net_surplus_margin_pct",
    "is_deficit", "ebitda_rag", "surplus_rag",
]


def scorecard(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, ebitda_rag=EBITDA_RAG) -> DataFrame:
    """The wide annual scorecard from one pass over the fact.

    Columns a query does not use are pruned out of the aggregation by Catalyst, and a filter on
    ``financial_year`` moves below it.
    """
    return expr.select(with_trust(_scorecard_rows(fact, dim_subcode, ebitda_rag), dim_trust), *SCORECARD_COLUMNS)


def scorecard_as_of(fact: DataFrame, history: DataFrame, dim_subcode: DataFrame, ebitda_rag=EBITDA_RAG) -> DataFrame:
    """The scorecard with every organisation as it was in the row's own year (``merge.build_trust_history``).

    A year before the first list that has the organisation takes its first entry. An organisation has as many entries as changes, and
    the facts have been reduced to organisation-years before they meet them.
    """
    rows = _scorecard_rows(fact, dim_subcode, ebitda_rag)
    held = history.select(*TRUST, F.when(F.col("entry") > 1, F.col("valid_from")).alias("since"), F.col("valid_before").alias("before"))
    in_time = "coalesce(financial_year >= since, true) AND coalesce(financial_year < before, true)"
    return expr.select(rows.join(held, "org_code").filter(in_time), *SCORECARD_COLUMNS)


def _scorecard_rows(fact: DataFrame, dim_subcode: DataFrame, ebitda_rag) -> DataFrame:
    """The scorecard without the attributes of the organisation."""
    columns = [
        *INCOME_LINES, *EXPENDITURE_CATEGORIES, *EXPENDITURE_LINES[:2], *WORKFORCE_LINES, *SCORECARD_LINES,
    ]
    rows = _with_kpis(pivot_lines(fact, columns, dim_subcode)).selectExpr(
        "*",
        f"{expr.rag('ebitda_margin_pct', *ebitda_rag)} AS ebitda_rag",
        """CASE WHEN net_surplus_000s IS NULL THEN 'Grey' WHEN net_surplus_000s < 0 THEN 'Red'
           WHEN net_surplus_000s = 0 THEN 'Amber' ELSE 'Green' END AS surplus_rag""",
    )
    return rows
