"""Flat datasets for reporting tools. Row order is left to the sink (see ``sources.sinks``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DecimalType

from provfin.functions import expr
from provfin.functions.session import materialise
from provfin.plans import enrich, views
from provfin.plans.trend import total_m
from provfin.plans.views import HEAD, TRUST
from provfin.refdata import WS_EXPENDITURE, WS_OTHER_INCOME, WS_PATIENT_INCOME, WS_SOCI
from provfin.sources import sinks

# Columns of the four subsets of the enriched scorecard.
CARD_EXTRACTS = {
    "kpis": [
        *HEAD, "total_income_000s", "ebitda_000s", "ebitda_margin_pct", "pay_000s", "pay_pct_income", "total_wte",
        "cost_per_wte_000s", "net_surplus_000s", "net_surplus_margin_pct", "is_deficit", "is_large",
        "pay_pressure_flag", "ebitda_rag", "ebitda_margin_yoy_pp",
    ],
    "ie_summary": [
        "org_code", "financial_year", "total_income_000s", "patient_care_income_000s", "other_income_000s",
        "total_expenditure_000s", "operating_surplus_000s", "net_surplus_000s", "patient_income_pct",
        "other_income_pct",
    ],
    "expenditure_breakdown": [
        "org_code", "financial_year", "pay_000s", "non_pay_000s", "depreciation_amort_000s", "drugs_cost_000s",
        "clinical_negligence_000s", "clinical_supplies_000s", "general_supplies_000s",
    ],
    "workforce": [
        "org_code", "financial_year", "total_wte", "total_staff_cost_000s", "gross_staff_cost_000s", "medical_wte",
        "nursing_wte",
    ],
}


def with_plain_numbers(df: DataFrame) -> DataFrame:
    """DECIMAL percentages as DOUBLE, the type reporting tools expect."""
    columns = [
        f"CAST({f.name} AS DOUBLE) AS {f.name}" if isinstance(f.dataType, DecimalType) else f.name
        for f in df.schema.fields
    ]
    return expr.select(df, *columns)


def card_extract(enriched: DataFrame, name: str) -> DataFrame:
    return with_plain_numbers(expr.select(enriched, *CARD_EXTRACTS[name]))


def dim_trust_extract(dim_trust: DataFrame) -> DataFrame:
    return dim_trust.select(
        "org_code", "organisation_name", "trust_type", "sector", "region", "is_foundation",
        "first_year_seen", "last_year_seen",
    )


def dim_financial_year_extract(dim_year: DataFrame) -> DataFrame:
    return dim_year.select("financial_year", "start_date", "end_date", "year_label_short", "is_complete")


def income_summary_extract(income: DataFrame) -> DataFrame:
    return income.select(
        *HEAD, "patient_care_income_000s", "other_income_000s", "total_income_000s", "total_expenditure_000s",
        "operating_surplus_000s", "net_surplus_000s",
    )


def expenditure_extract(breakdown: DataFrame) -> DataFrame:
    return breakdown.select(
        *HEAD, "pay_000s", "non_pay_000s", "depreciation_amort_000s", "drugs_cost_000s", "staff_cost_000s",
        "total_expenditure_000s",
    )


def workforce_extract(workforce: DataFrame) -> DataFrame:
    return workforce.filter("total_staff_cost_000s IS NOT NULL").select(
        *HEAD, "total_staff_cost_000s", "gross_staff_cost_000s", "total_wte", "medical_wte", "nursing_wte",
        "admin_estates_wte", "scientific_tech_wte", "avg_days_lost_per_wte",
    )


def kpi_extract(kpis: DataFrame) -> DataFrame:
    rows = kpis.filter("total_income_000s > 0").select(
        *HEAD, "total_income_000s", "total_expenditure_000s", "operating_surplus_000s", "net_surplus_000s",
        "pay_000s", "drugs_cost_000s", "depreciation_amort_000s", "ebitda_000s", "ebitda_margin_pct",
        "pay_pct_income", "cost_per_wte_000s", "net_surplus_margin_pct", "total_wte",
    )
    return with_plain_numbers(rows)


def _detail(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, keep: str) -> DataFrame:
    """Account lines with their organisation and line description.

    The fact is filtered before the joins. Hot organisations are left to AQE, which splits skewed join
    partitions when the dimension is too large to broadcast.
    """
    trusts = dim_trust.select(*TRUST)
    codes = dim_subcode.select("sub_code", "description", "analytics_category", "is_subtotal")
    lines = fact.filter(keep).selectExpr(
        "org_code", "financial_year", "worksheet_name", "sub_code", f"{expr.amount(fact)} AS amount_000s"
    )
    return lines.join(codes, "sub_code").join(trusts, "org_code")


def _on(*sheets: str) -> str:
    return f"worksheet_name IN ({', '.join(map(expr.literal, sheets))})"


CURRENT = "main_code NOT LIKE '%PY%'"
INCOME_SHEETS, COST_SHEETS = (WS_PATIENT_INCOME, WS_OTHER_INCOME), (WS_EXPENDITURE,)


def _leaf_lines(detail: DataFrame, *sheets: str) -> DataFrame:
    return detail.filter(f"{_on(*sheets)} AND is_subtotal = 0").selectExpr(
        "org_code", "organisation_name", "sector", "trust_type", "financial_year", "sub_code",
        "description AS line_item", "analytics_category", "amount_000s",
    )


def income_detail(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame) -> DataFrame:
    """Current-year income lines below the subtotals."""
    return _leaf_lines(_detail(fact, dim_trust, dim_subcode, f"{_on(*INCOME_SHEETS)} AND {CURRENT}"), *INCOME_SHEETS)


def expenditure_detail(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame) -> DataFrame:
    """Current-year cost lines below the subtotals."""
    return _leaf_lines(_detail(fact, dim_trust, dim_subcode, f"{_on(*COST_SHEETS)} AND {CURRENT}"), *COST_SHEETS)


def income_detail_full(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame) -> DataFrame:
    """All income lines of three worksheets, subtotals included."""
    return _income_lines(_detail(fact, dim_trust, dim_subcode, _on(*INCOME_SHEETS, WS_SOCI)))


def _income_lines(detail: DataFrame) -> DataFrame:
    income = f"{_on(*INCOME_SHEETS, WS_SOCI)} AND analytics_category IN ('PATIENT_INCOME', 'OTHER_INCOME', 'TOTAL_INCOME')"
    return detail.filter(income).selectExpr(
        *HEAD, "worksheet_name", "sub_code", "description AS sub_code_description", "is_subtotal",
        "amount_000s AS value_000s",
    )


def expenditure_detail_full(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame) -> DataFrame:
    """All cost lines, subtotals included."""
    return _cost_lines(_detail(fact, dim_trust, dim_subcode, _on(*COST_SHEETS)))


def _cost_lines(detail: DataFrame) -> DataFrame:
    return detail.filter(_on(*COST_SHEETS)).selectExpr(
        *HEAD, "sub_code", "description AS sub_code_description", "analytics_category", "is_subtotal",
        "amount_000s AS value_000s",
    )


def sector_benchmarks(kpis: DataFrame) -> DataFrame:
    """Totals, averages and deficit counts by year, sector and trust type."""
    columns = {
        "provider_count": "count(org_code)",
        "total_income_m": total_m("total_income_000s"),
        "total_expenditure_m": total_m("total_expenditure_000s"),
        "total_op_surplus_m": total_m("operating_surplus_000s"),
        "avg_ebitda_margin_pct": expr.mean("ebitda_margin_pct"),
        "avg_pay_pct_income": expr.mean("pay_pct_income"),
        "avg_net_surplus_margin_pct": expr.mean("net_surplus_margin_pct"),
        "deficit_count": "count_if(operating_surplus_000s < 0)",
        "surplus_count": "count_if(operating_surplus_000s >= 0)",
    }
    return (
        kpis.filter("total_income_000s > 0 AND sector IS NOT NULL")
        .groupBy("financial_year", "sector", "trust_type")
        .agg(*expr.named(columns))
    )


def with_dimensions(extract: DataFrame, dim_trust: DataFrame, dim_year: DataFrame) -> DataFrame:
    """An extract with the attributes of its organisation and year: the many-to-one links of a report model.

    Every extract row stays, also one whose organisation or year the dimensions do not know.
    """
    trust = dim_trust.select("org_code", "organisation_name", "trust_type", "sector", "region", "is_foundation")
    year = dim_year.select("financial_year", "start_date", "end_date", "year_label_short")
    given = {c for c in extract.columns if c not in ("org_code", "financial_year")}
    return (
        extract.join(trust.drop(*given), "org_code", "left").join(year.drop(*given), "financial_year", "left")
    )


# The datasets of the report model that are linked to both dimensions.
LINKED = ["kpis", "ie_summary", "expenditure_breakdown", "workforce", "income_detail", "expenditure_detail"]


def linkable(name: str, fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame) -> DataFrame:
    """A dataset of the report model by name."""
    if name in CARD_EXTRACTS:
        return card_extract(enrich.enrich(views.scorecard(fact, dim_trust, dim_subcode)), name)
    return {"income_detail": income_detail, "expenditure_detail": expenditure_detail}[name](fact, dim_trust, dim_subcode)


def write_model(folder: str, prefix: str, frames: dict[str, DataFrame], dim_trust: DataFrame, buckets: int = 16) -> dict[str, DataFrame]:
    """Writes datasets and the organisation dimension as tables in buckets of the organisation; returns them by name, ``dim_trust`` too.

    ``with_dimensions`` of these tables joins the organisation bucket by bucket: nothing of a dataset is shuffled for it.
    """
    named = {**frames, "dim_trust": dim_trust_extract(dim_trust) if "first_year_seen" in dim_trust.columns else dim_trust}
    return {name: sinks.write_bucketed(df, f"{prefix}_{name}", f"{folder}/{name}", buckets) for name, df in named.items()}


ROW_ORDER = {
    "dim_trust": ["organisation_name"],
    "dim_financial_year": ["financial_year"],
    "income_detail": ["financial_year", "org_code", "sub_code"],
    "expenditure_detail": ["financial_year", "org_code", "sub_code"],
    "sector_benchmarks": ["financial_year", "sector"],
}
DEFAULT_ORDER = ["financial_year", "org_code"]


def report_set(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, dim_year: DataFrame) -> dict[str, DataFrame]:
    """The datasets of the views, by name.

    The fact is read twice, for what the views pivot and for the lines; both are written out, as sorting an extract reads its input twice.
    """
    view = views.narrow_views(materialise(views.wide_rows(fact, dim_subcode)), dim_trust)
    detail = materialise(_detail(fact, dim_trust, dim_subcode, f"{_on(*INCOME_SHEETS, *COST_SHEETS)} AND {CURRENT}"))
    return {
        "dim_trust": dim_trust_extract(dim_trust),
        "dim_financial_year": dim_financial_year_extract(dim_year),
        "ie_summary": income_summary_extract(view["income_expenditure"]),
        "expenditure_breakdown": expenditure_extract(view["expenditure_breakdown"]),
        "workforce": workforce_extract(view["workforce"]),
        "kpis": kpi_extract(view["kpis"]),
        "income_detail": _leaf_lines(detail, *INCOME_SHEETS),
        "expenditure_detail": _leaf_lines(detail, *COST_SHEETS),
        "sector_benchmarks": sector_benchmarks(view["kpis"]),
    }


def enriched_set(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, dim_year: DataFrame) -> dict[str, DataFrame]:
    """The datasets of the enriched scorecard, by name. The scorecard is written out once and read by five of them, the lines once for two."""
    detail = materialise(_detail(fact, dim_trust, dim_subcode, _on(*INCOME_SHEETS, WS_SOCI, *COST_SHEETS)))
    card = materialise(enrich.enrich(views.scorecard(fact, dim_trust, dim_subcode)))
    return {
        **{name: card_extract(card, name) for name in CARD_EXTRACTS},
        "sector_benchmarks": enrich.sector_benchmarks(card),
        "income_detail": _income_lines(detail),
        "expenditure_detail": _cost_lines(detail),
        "dim_trust": dim_trust_extract(dim_trust),
        "dim_financial_year": dim_financial_year_extract(dim_year),
    }
