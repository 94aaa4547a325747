"""Report measures under a filter context.

``totals`` applies the slicers and adds up every base quantity along the axes in one aggregation; each
measure group is then a projection of it, and Catalyst drops the sums a group does not use. Without
axes there is always one row, also for an empty selection: amounts are 0, ratios NULL, statuses Grey.
All but ``benchmark`` and ``labels`` also take a cube (``plans.totals.cube``) in place of the scorecard and then read no fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.functions.expr import named
from provfin.plans.totals import select_context, totals
from provfin.refdata import EBITDA_RAG, PAY_RAG, PRIOR_YEAR, RAG_COLOUR_OTHER, RAG_COLOURS, SURPLUS_RAG

def _millions(name: str) -> str:
    return f"coalesce(CAST({name} AS DOUBLE) / 1000D, 0D)"


def _percent(num: str, den: str) -> str:
    return expr.divide(num, den, 100)


def _project(summed: DataFrame, by: list[str], columns: dict[str, str]) -> DataFrame:
    return summed.select(*by, *named(columns))


CORE = {
    "total_income_m": "income",
    "patient_care_income_m": "patient_income",
    "other_income_m": "other_income",
    "total_expenditure_m": "expenditure",
    "operating_surplus_m": "operating_surplus",
    "net_surplus_m": "net_surplus",
    "total_pay_m": "pay",
    "total_non_pay_m": "non_pay",
    "depreciation_amort_m": "depreciation",
    "drugs_cost_m": "drugs",
    "clinical_negligence_m": "negligence",
}


def core(card: DataFrame, by: list[str], filters=None) -> DataFrame:
    """Income, cost and surplus in £m."""
    return _project(totals(card, by, filters), by, {name: _millions(q) for name, q in CORE.items()})


def kpi(card: DataFrame, by: list[str], filters=None) -> DataFrame:
    """Weighted margins and deficit counts."""
    columns = {
        "ebitda_m": _millions("ebitda"),
        "ebitda_margin_pct": _percent("ebitda", "income"),
        "pay_pct_income": _percent("pay", "income"),
        "net_surplus_margin_pct": _percent("net_surplus", "income"),
        "deficit_trusts": "deficit_trusts",
        "surplus_trusts": "surplus_trusts",
        "total_trusts": "total_trusts",
        "deficit_pct": _percent("deficit_trusts", "total_trusts"),
    }
    return _project(totals(card, by, filters), by, columns)


def workforce(card: DataFrame, by: list[str], filters=None) -> DataFrame:
    columns = {
        "total_wte": "wte",
        "total_staff_cost_m": _millions("staff_cost"),
        "avg_cost_per_wte_000s": expr.divide("staff_cost", "wte"),
        "medical_wte": "medical",
        "nursing_wte": "nursing",
        "medical_pct_wte": _percent("medical", "wte"),
        "nursing_pct_wte": _percent("nursing", "wte"),
    }
    return _project(totals(card, by, filters), by, columns)


def yoy(card: DataFrame, by: list[str] | None = None, filters=None, prior_year: dict[str, str] = PRIOR_YEAR) -> DataFrame:
    """Every year against its prior year as given by ``prior_year``.

    A year slicer limits the years shown, not the prior years read. Each year's totals are emitted twice,
    once for itself and once for the year they are prior to, and met again by grouping: the scorecard is
    aggregated once and nothing is joined.
    """
    axes = list(by or [])
    filters = dict(filters or {})
    shown = filters.pop("financial_year", None)
    base = totals(card, [*axes, "financial_year"], filters)
    values = "struct(income, ebitda, pay, deficit_trusts)"
    nothing = "CAST(NULL AS STRUCT<income: BIGINT, ebitda: BIGINT, pay: BIGINT, deficit_trusts: BIGINT>)"
    following = expr.lookup("financial_year", {v: k for k, v in prior_year.items()})
    both = base.selectExpr(
        *axes,
        f"""inline(array(struct(financial_year AS year, {values} AS now, {nothing} AS before),
                        struct({following} AS year, {nothing} AS now, {values} AS before)))""",
    )
    met = (
        both.filter("year IS NOT NULL")
        .groupBy(*axes, F.col("year").alias("financial_year"))
        .agg(F.max("now").alias("now"), F.max("before").alias("before"))
        .filter("now IS NOT NULL")
    )
    if shown is not None:
        met = met.filter(F.col("financial_year").isin(*shown))
    previous = expr.lookup("financial_year", prior_year)
    now_income = _millions("now.income")
    prior_income = f"CASE WHEN {previous} IS NOT NULL THEN {_millions('before.income')} END"
    margin, prior_margin = _percent("now.ebitda", "now.income"), _percent("before.ebitda", "before.income")
    pay, prior_pay = _percent("now.pay", "now.income"), _percent("before.pay", "before.income")
    prior_deficits = f"CASE WHEN {previous} IS NOT NULL THEN coalesce(before.deficit_trusts, 0) END"
    columns = {
        "prior_year": previous,
        "prior_year_income_m": prior_income,
        "income_yoy_growth_pct": expr.divide(f"({now_income} - ({prior_income}))", f"({prior_income})", 100),
        "prior_year_ebitda_margin_pct": prior_margin,
        "ebitda_margin_yoy_pp": f"{margin} - {prior_margin}",
        "prior_year_pay_pct": prior_pay,
        "pay_yoy_pp": f"{pay} - {prior_pay}",
        "prior_year_deficit_trusts": prior_deficits,
        "deficit_trusts_yoy_change": f"now.deficit_trusts - ({prior_deficits})",
    }
    return _project(met, [*axes, "financial_year"], columns)


def rag(card: DataFrame, by: list[str], filters=None, ebitda=EBITDA_RAG, surplus=SURPLUS_RAG, pay=PAY_RAG) -> DataFrame:
    """Statuses of the aggregated ratios, and their colours."""
    statuses = {
        "ebitda_rag": expr.rag(_percent("ebitda", "income"), *ebitda),
        "surplus_rag": expr.rag(_percent("net_surplus", "income"), *surplus),
        "pay_rag": expr.rag_below(_percent("pay", "income"), *pay),
    }
    other = f"'{RAG_COLOUR_OTHER}'"
    return _project(totals(card, by, filters), by, statuses).selectExpr(
        "*",
        f"{expr.lookup('ebitda_rag', RAG_COLOURS, other)} AS ebitda_rag_colour",
        f"{expr.lookup('surplus_rag', RAG_COLOURS, other)} AS surplus_rag_colour",
    )


def benchmark(card: DataFrame, by: list[str], filters=None) -> DataFrame:
    """Mean over sectors of their benchmark margin, and the distance of the weighted margin from it.

    ``by`` are axes of year and sector. The scorecard is reduced once to years and sectors, and both levels are rolled up from
    that. Filters on the year or sector hold for both sides, other filters for the own margin alone.
    """
    filters = filters or {}
    shared = {c: v for c, v in filters.items() if c in ("financial_year", "sector")}
    chosen = F.lit(True)
    for column, values in filters.items():
        if column not in shared:
            chosen = chosen & F.coalesce(F.col(column).isin(*values), F.lit(False))
    margin = "CASE WHEN financial_year IS NOT NULL AND sector IS NOT NULL THEN bround(avg(ebitda_margin_pct), 1) END"
    base = {
        "ebitda": "sum(CASE WHEN chosen THEN ebitda_000s END)",
        "income": "sum(CASE WHEN chosen THEN total_income_000s END)",
        "own": "count_if(chosen)",
        "tenths": f"CAST(({margin}) * 10 AS BIGINT)",
    }
    years = select_context(card, shared).withColumn("chosen", chosen).groupBy("financial_year", "sector").agg(*named(base))
    sums = {c: f"sum({c})" for c in ("ebitda", "income", "own")}
    sectors = years.groupBy(*dict.fromkeys([*by, "sector"])).agg(
        *named(sums | {"sector_tenths": expr.divide("sum(tenths)", "count(tenths)")})
    )
    met = sectors.groupBy(*by).agg(
        *named(sums | {"level": f"{expr.divide('sum(sector_tenths)', 'count(sector_tenths)')} / 10D"})
    )
    columns = {
        "sector_benchmark_ebitda_pct": "level",
        "ebitda_vs_benchmark_pp": f"{_percent('ebitda', 'income')} - level",
    }
    return _project(met.filter("own > 0"), by, columns)


def labels(card: DataFrame, by: list[str], filters=None) -> DataFrame:
    """Texts that follow the selection."""

    def selected(column: str, default: str) -> str:
        one = f"min({column}) = max({column}) AND count({column}) = count(*)"
        return f"CASE WHEN {one} THEN min({column}) ELSE '{default}' END"

    summed = {
        "surplus": "coalesce(sum(operating_surplus_000s), 0)",
        "ebitda": "sum(ebitda_000s)",
        "income": "sum(total_income_000s)",
        "deficit_trusts": "count_if(operating_surplus_000s < 0)",
        "total_trusts": "count(DISTINCT org_code)",
        "selected_year": selected("financial_year", "All Years"),
        "selected_sector": selected("sector", "All Sectors"),
        "selected_region": selected("region", "All Regions"),
    }
    amount = expr.kpi("abs(surplus)", "1000")
    margin = expr.kpi("ebitda", "income", 100)
    columns = {
        "selected_year": "selected_year",
        "selected_sector": "selected_sector",
        "selected_region": "selected_region",
        "page_title": "concat('Income & Expenditure — ', selected_year, ' | ', selected_sector)",
        "surplus_label": f"concat('£', {amount}, CASE WHEN surplus >= 0 THEN 'm surplus' ELSE 'm deficit' END)",
        "ebitda_label": f"concat(coalesce(CAST({margin} AS STRING), ''), '% EBITDA margin')",
        "deficit_count_label": "concat(deficit_trusts, ' of ', total_trusts, ' trusts in deficit')",
    }
    return _project(select_context(card, filters).groupBy(*by).agg(*named(summed)), by, columns)
