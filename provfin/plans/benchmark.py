"""Peer benchmarks over the annual scorecard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.functions.expr import named
from provfin.operators.ranking import ntile
from provfin.plans.trend import DEFICITS, MILLION, STATUS, in_year, mean_share, total_bn, total_m
from provfin.refdata import PAY_AMBER_DEFAULT, PAY_AMBER_THRESHOLD, WORKING_DAYS

# Names of the income quartiles.
SIZE_BANDS = {1: "Q1 — Smallest", 2: "Q2 — Small–Medium", 3: "Q3 — Medium–Large", 4: "Q4 — Largest"}


def size_bands(card: DataFrame, year: str) -> DataFrame:
    """Income quartiles of one year and the average KPIs of each; ties are split by organisation code."""
    rows = in_year(card, year).select(
        "org_code", "financial_year", "total_income_000s", "ebitda_margin_pct", "pay_pct_income",
        "cost_per_wte_000s", "is_deficit",
    )
    banded = ntile(rows, 4, ["financial_year"], ["total_income_000s", "org_code"], "income_quartile")
    columns = {
        "trust_count": "count(*)",
        "min_income_m": expr.scaled("min(total_income_000s)", MILLION, 0),
        "max_income_m": expr.scaled("max(total_income_000s)", MILLION, 0),
        "avg_ebitda_pct": expr.mean("ebitda_margin_pct"),
        "avg_pay_pct": expr.mean("pay_pct_income"),
        "avg_cost_per_wte_000s": expr.mean("cost_per_wte_000s"),
        "deficit_trusts": DEFICITS,
    }
    return (
        banded.groupBy("income_quartile")
        .agg(*named(columns))
        .selectExpr("*", f"{expr.lookup('income_quartile', SIZE_BANDS)} AS size_band")
        .orderBy("income_quartile")
    )


def trust_type_compare(card: DataFrame) -> DataFrame:
    columns = {
        "providers": "count(*)",
        "avg_ebitda_pct": expr.mean("ebitda_margin_pct"),
        "avg_pay_pct": expr.mean("pay_pct_income"),
        "avg_net_surplus_pct": expr.mean("net_surplus_margin_pct"),
        "deficit_count": DEFICITS,
        "total_surplus_m": total_m("operating_surplus_000s"),
        "total_income_bn": total_bn("total_income_000s"),
    }
    return (
        card.filter("trust_type IS NOT NULL")
        .groupBy("financial_year", "trust_type")
        .agg(*named(columns))
        .orderBy("financial_year", "trust_type")
    )


def pay_threshold(thresholds: dict, default) -> str:
    """Pay threshold of a row's sector; ``default`` None gives an unknown sector no threshold."""
    return f"CAST({expr.lookup('sector', thresholds, 'NULL' if default is None else str(default))} AS {expr.PCT})"


def pay_pressure(
    card: DataFrame, year: str, limit: int = 30, thresholds=PAY_AMBER_THRESHOLD, default=PAY_AMBER_DEFAULT
) -> DataFrame:
    """Organisations above their sector's pay threshold, by how far; an unknown sector has the default."""
    return (
        in_year(card, year)
        .selectExpr("*", f"{pay_threshold(thresholds, default)} AS threshold")
        .filter("pay_pct_income > threshold")
        .selectExpr("*", "pay_pct_income - threshold AS excess")
        .orderBy(F.desc("excess"), "org_code")
        .limit(limit)
        .selectExpr(
            "org_code",
            "organisation_name",
            "sector",
            "region",
            "trust_type",
            "financial_year",
            "CAST(pay_pct_income AS DOUBLE) AS pay_pct",
            "CAST(threshold AS DOUBLE) AS sector_amber_threshold_pct",
            "CAST(excess AS DOUBLE) AS excess_pp",
            "CAST(ebitda_margin_pct AS DOUBLE) AS ebitda_margin",
        )
    )


def regional_health(card: DataFrame, year: str) -> DataFrame:
    columns = {
        "trusts": "count(org_code)",
        "total_income_m": total_m("total_income_000s"),
        "total_surplus_m": total_m("operating_surplus_000s"),
        "sector_op_margin_pct": expr.weighted_pct("operating_surplus_000s", "total_income_000s"),
        "avg_ebitda_pct": expr.mean("ebitda_margin_pct"),
        "avg_pay_pct": expr.mean("pay_pct_income"),
        "deficit_trusts": DEFICITS,
        "deficit_pct": expr.pct("sum(is_deficit)", "count(*)", 0),
    }
    return (
        in_year(card, year)
        .filter("region IS NOT NULL")
        .groupBy("region")
        .agg(*named(columns))
        .orderBy(F.desc("deficit_pct"), "region")
    )


def cost_per_wte(card: DataFrame) -> DataFrame:
    columns = {
        "trusts": "count(*)",
        "avg_cost_per_wte_000s": expr.mean("cost_per_wte_000s"),
        "min_cost_per_wte_000s": expr.double("min(cost_per_wte_000s)"),
        "max_cost_per_wte_000s": expr.double("max(cost_per_wte_000s)"),
        "total_pay_bill_m": total_m("total_staff_cost_000s"),
        "total_wte": "sum(total_wte)",
    }
    return (
        card.filter("sector IS NOT NULL AND total_wte > 0 AND cost_per_wte_000s IS NOT NULL")
        .groupBy("financial_year", "sector")
        .agg(*named(columns))
        .orderBy("financial_year", "sector")
    )


def private_income(card: DataFrame, year: str, limit: int = 25) -> DataFrame:
    return (
        in_year(card, year)
        .filter("private_patient_income_000s > 0")
        .orderBy(F.desc("private_patient_income_000s"), "org_code")
        .limit(limit)
        .selectExpr(
            "org_code",
            "organisation_name",
            "sector",
            "region",
            "financial_year",
            f"{expr.scaled('private_patient_income_000s', MILLION, 1)} AS private_income_m",
            f"{expr.scaled('total_income_000s', MILLION, 0)} AS total_income_m",
            f"{expr.pct('private_patient_income_000s', 'total_income_000s', 2)} AS private_pct",
        )
    )


def negligence_sector(card: DataFrame) -> DataFrame:
    columns = {
        "trusts_reporting": "count(org_code)",
        "total_neg_m": total_m("clinical_negligence_000s"),
        "neg_pct_income": expr.weighted_pct("clinical_negligence_000s", "total_income_000s", 2),
        "avg_neg_pct_per_trust": mean_share("clinical_negligence_000s", "total_income_000s", 2),
    }
    return (
        card.filter("clinical_negligence_000s IS NOT NULL AND sector IS NOT NULL")
        .groupBy("financial_year", "sector")
        .agg(*named(columns))
        .orderBy("financial_year", F.desc("neg_pct_income"), "sector")
    )


def ebitda_movers(card: DataFrame, year: str, prior: str, limit: int = 30) -> DataFrame:
    """Change in margin between two years, most deteriorated first.

    Both years of an organisation are read in one pass and paired by aggregation, instead of joining the scorecard to itself.
    Its attributes are those of the organisation dimension in either year, so they are grouping keys: no text is aggregated.
    """

    def value(column: str, y: str) -> str:
        return f"max(CASE WHEN financial_year = {expr.literal(y)} THEN {column} END)"

    columns = {c: value(c, year) for c in ("total_income_000s", "is_deficit")}
    columns |= {
        "before": value("ebitda_margin_pct", prior),
        "after": value("ebitda_margin_pct", year),
        "years": "count(*)",
    }
    return (
        card.filter(F.col("financial_year").isin(year, prior) & (F.col("total_income_000s") > 0))
        .groupBy("org_code", "organisation_name", "sector", "region")
        .agg(*named(columns))
        .filter("years = 2")
        .selectExpr("*", "after - before AS change")
        .orderBy(F.asc_nulls_first("change"), "org_code")
        .limit(limit)
        .selectExpr(
            "org_code",
            "organisation_name",
            "sector",
            "region",
            f"{expr.scaled('total_income_000s', MILLION, 0)} AS income_m",
            "CAST(before AS DOUBLE) AS ebitda_prior_pct",
            "CAST(after AS DOUBLE) AS ebitda_current_pct",
            "CAST(change AS DOUBLE) AS yoy_change_pp",
            f"{expr.signed_label('change', 'pp')} AS yoy_change",
            f"{STATUS} AS status_current",
        )
    )


def sickness_cost(card: DataFrame, working_days: int = WORKING_DAYS) -> DataFrame:
    """Days lost, and their cost at one working day's pay: days * WTE * cost per WTE / working days.

    The division is taken out of the sum, which keeps the sum exact.
    """
    pay_days = "CAST(avg_days_lost_per_wte * total_wte * CAST(cost_per_wte_000s * 10 AS BIGINT) AS DECIMAL(20,0))"
    columns = {
        "trusts": "count(*)",
        "avg_days_lost_per_wte": expr.mean(f"CAST(avg_days_lost_per_wte AS {expr.PCT})"),
        "total_wte": "sum(total_wte)",
        "est_sickness_cost_m": expr.ratio(f"sum({pay_days})", str(working_days * 10 * MILLION), 0),
    }
    return (
        card.filter(
            "avg_days_lost_per_wte IS NOT NULL AND total_wte > 0 AND cost_per_wte_000s IS NOT NULL AND sector IS NOT NULL"
        )
        .groupBy("financial_year", "sector")
        .agg(*named(columns))
        .orderBy("financial_year", F.desc("avg_days_lost_per_wte"), "sector")
    )


def rd_education_income(card: DataFrame, year: str, limit: int = 25) -> DataFrame:
    rd_edu = "coalesce(rd_income_000s, 0) + coalesce(education_training_income_000s, 0)"
    return (
        in_year(card, year)
        .filter("rd_income_000s > 0 OR education_training_income_000s > 0")
        .selectExpr("*", f"{rd_edu} AS rd_edu")
        .orderBy(F.desc("rd_edu"), "org_code")
        .limit(limit)
        .selectExpr(
            "org_code",
            "organisation_name",
            "sector",
            "region",
            "financial_year",
            f"{expr.scaled('rd_income_000s', MILLION, 1)} AS rd_income_m",
            f"{expr.scaled('education_training_income_000s', MILLION, 1)} AS education_income_m",
            f"{expr.scaled('rd_edu', MILLION, 1)} AS rd_edu_total_m",
            f"{expr.pct('rd_edu', 'total_income_000s')} AS rd_edu_pct_income",
            "CAST(ebitda_margin_pct AS DOUBLE) AS ebitda_margin",
        )
    )
