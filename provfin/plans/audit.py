"""Checks of a loaded fact table, the gate before a load, and the validation reports."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provfin.functions import expr
from provfin.functions.expr import named
from provfin.operators.ingest import inspected_lines
from provfin.operators.pivot import Line, pivot_lines
from provfin.plans.trend import BILLION, MILLION, in_year, total_bn, total_m
from provfin.plans.views import (
    EBITDA,
    EXPENDITURE_CATEGORIES,
    INCOME_LINES,
    TOTAL_EXPENDITURE,
    TOTAL_INCOME,
    with_trust,
)
from provfin.refdata import BALANCE_TOLERANCE_000S, EXPECTED, WS_STAFF, WTE_MAX

FACT_KEY = ["org_code", "financial_year", "main_code", "sub_code"]


# Names and texts of the checks below are fixed values: reports are read by them.


def _check(name: str, severity: str, passed: str, detail: str) -> str:
    return (
        f"struct({expr.literal(name)} AS check_name, '{severity}' AS severity, coalesce({passed}, false) AS passed, "
        f"{detail} AS detail)"
    )


#: A check: the metric it needs, its name, and the row it becomes.
Check = tuple[str, str, str]


class _Checks:
    """Checks that one aggregation can answer together, or each alone from its own metric."""

    def __init__(self, spark: SparkSession, together: Callable[[], DataFrame], alone: Callable[[str], DataFrame], checks: list[Check]):
        self.spark, self.build, self.metric, self.checks = spark, together, alone, checks

    def together(self) -> DataFrame:
        """All checks from one aggregation; if that cannot be planned, each alone, so a failing one loses only itself."""
        try:
            return self.build().selectExpr(f"inline(array({', '.join(row for *_, row in self.checks)}))")
        except AnalysisException:
            return reduce(DataFrame.unionByName, (_guarded(self.spark, name, build) for name, build in self.alone()))

    def alone(self) -> list[tuple[str, Callable[[], DataFrame]]]:
        """Name and frame of every check."""
        return [(name, lambda m=metric, r=row: self.metric(m).selectExpr(f"inline(array({r}))")) for metric, name, row in self.checks]


def _named_check(metric: str, name: str, severity: str, passed: str, detail: str) -> Check:
    return metric, name, _check(name, severity, passed, detail)


def _text(value: str, *rest: str) -> str:
    """Text of a value between fixed texts: SQL first, then literals (``£`` style prefixes go in SQL)."""
    return f"concat({value}, {expr.literal(''.join(rest))})"


def _key_checks(fact: DataFrame, dim_trust: DataFrame, expected: dict) -> _Checks:
    """Size, coverage, blank codes, duplicate keys and orphans from one pass over the fact.

    Lines are counted by fact key, the counts by organisation, and only those meet the dimension.
    """
    years = expected["years"]
    per_year = {f"year{i}": f"count_if(financial_year = {expr.literal(y)})" for i, y in enumerate(years)}
    blank = "org_code IS NULL OR trim(org_code) = ''"
    orphan = "count_if(known IS NULL AND org_code IS NOT NULL) AS orphans"

    def known() -> DataFrame:
        return dim_trust.selectExpr("org_code", "1 AS known")

    def together() -> DataFrame:
        keys = fact.groupBy(*FACT_KEY).agg(F.count(F.lit(1)).alias("n"))
        orgs = expr.aggregate(keys, ["org_code"], {"lines": "sum(n)", "repeated": "count_if(n > 1)"} | per_year)
        columns = {
            "rows": "coalesce(sum(lines), 0)",
            "dupes": "coalesce(sum(repeated), 0)",
            "blanks": f"coalesce(sum(CASE WHEN {blank} THEN lines END), 0)",
        } | {year: f"coalesce(sum({year}), 0)" for year in per_year}
        return orgs.join(known(), "org_code", "left").agg(*named(columns), F.expr(orphan))

    def alone(metric: str) -> DataFrame:
        if metric == "dupes":
            keys = fact.groupBy(*FACT_KEY).agg(F.count(F.lit(1)).alias("n"))
            return keys.selectExpr("count_if(n > 1) AS dupes")
        if metric == "orphans":
            return fact.select("org_code").distinct().join(known(), "org_code", "left").selectExpr(orphan)
        sql = {"rows": "count(*)", "blanks": f"count_if({blank})"} | per_year
        return fact.selectExpr(f"{sql[metric]} AS {metric}")

    minimum = expected["fact_row_min"]
    coverage = [
        _named_check(
            f"year{i}",
            f"year coverage: {y}",
            "CRITICAL",
            f"year{i} > 0",
            _text(f"CASE WHEN year{i} > 0 THEN 'found' ELSE 'MISSING' END", " in fct_tac"),
        )
        for i, y in enumerate(years)
    ]
    checks = [
        _named_check(
            "rows",
            "fct_tac row count",
            "CRITICAL",
            f"rows >= {minimum}",
            _text("format_number(rows, 0)", f" rows (expected ≥ {minimum:,})"),
        ),
        *coverage,
        _named_check(
            "blanks", "no null org_codes in fct_tac", "CRITICAL", "blanks = 0", _text("blanks", " rows with null/empty org_code")
        ),
        _named_check(
            "dupes",
            "no duplicate fact keys",
            "CRITICAL",
            "dupes = 0",
            _text("dupes", " duplicate (org_code, year, main_code, sub_code) combinations"),
        ),
        _named_check(
            "orphans",
            "no orphan org_codes in fct_tac",
            "CRITICAL",
            "orphans = 0",
            _text("orphans", " org_codes in fct_tac not in dim_trust"),
        ),
    ]
    return _Checks(fact.sparkSession, together, alone, checks)


def _trust_count(dim_trust: DataFrame, expected: dict) -> _Checks:
    minimum = expected["trust_count_min"]
    count = lambda *_: dim_trust.agg(F.count(F.lit(1)).alias("n"))
    detail = _text("n", f" trusts (expected ≥ {minimum})")
    return _Checks(dim_trust.sparkSession, count, count, [_named_check("n", "dim_trust row count", "CRITICAL", f"n >= {minimum}", detail)])


def _view_checks(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, expected: dict) -> _Checks:
    """The six rules on the views, from one organisation-year pivot and one global aggregation."""
    year, sector = expected["year"], expected["pay_sector"].lower()
    now = f"financial_year = {expr.literal(year)}"

    def years_of(trusts: DataFrame) -> DataFrame:
        columns = [*INCOME_LINES, *EXPENDITURE_CATEGORIES, Line("total_wte", "STA0410", WS_STAFF)]
        rows = with_trust(pivot_lines(fact, columns, dim_subcode), trusts)
        return rows.selectExpr(
            "*", f"{TOTAL_INCOME} AS income", f"{TOTAL_EXPENDITURE} AS expenditure", f"{EBITDA} AS ebitda"
        ).selectExpr(
            "*",
            f"{expr.kpi('ebitda', 'income', 100)} AS margin",
            f"{expr.kpi('pay_000s', 'income', 100)} AS pay_pct",
            f"{now} AS now",
            f"{now} AND income > 0 AS earning",
        )

    def average(condition: str, column: str) -> str:
        return f"CAST(coalesce(round(avg(CASE WHEN {condition} THEN {column} END), 1), 0) AS {expr.PCT})"

    metrics = {
        "income": "coalesce(sum(CASE WHEN now THEN income END), 0)",
        "deficits": "count_if(earning AND operating_surplus_000s < 0)",
        "margin": average("earning", "margin"),
        "pay_pct": average(f"earning AND sector = {expr.literal(expected['pay_sector'])}", "pay_pct"),
        "unbalanced": f"count_if(abs(income - expenditure - operating_surplus_000s) > {BALANCE_TOLERANCE_000S})",
        "implausible": f"count_if(total_wte <= 0 OR total_wte > {WTE_MAX})",
    }

    def alone(metric: str) -> DataFrame:
        trusts = dim_trust
        if metric != "pay_pct":  # the only one that asks for an attribute
            for column in ("organisation_name", "sector", "region", "trust_type"):
                if column not in trusts.columns:
                    trusts = trusts.withColumn(column, F.lit(None).cast("string"))
        return years_of(trusts).agg(*named({metric: metrics[metric]}))

    (i_lo, i_hi), (d_lo, d_hi) = expected["income_bn"], expected["deficit_trusts"]
    (e_lo, e_hi), (p_lo, p_hi) = expected["avg_ebitda_pct"], expected["avg_pay_pct"]
    income_bn = f"concat('£', CAST(round(income / {BILLION}BD, 1) AS {expr.PCT}))"
    checks = [
        _named_check(
            "income",
            f"total income {year} in expected range",
            "WARNING",
            f"income BETWEEN {i_lo * BILLION} AND {i_hi * BILLION}",
            _text(income_bn, f"bn (expected £{i_lo}–{i_hi}bn)"),
        ),
        _named_check(
            "deficits",
            f"deficit trust count {year}",
            "WARNING",
            f"deficits BETWEEN {d_lo} AND {d_hi}",
            _text("deficits", f" deficit trusts (expected {d_lo}–{d_hi})"),
        ),
        _named_check(
            "margin",
            f"avg EBITDA margin {year}",
            "WARNING",
            f"margin BETWEEN {e_lo} AND {e_hi}",
            _text("margin", f"% (expected {e_lo}–{e_hi}%)"),
        ),
        _named_check(
            "pay_pct",
            f"avg pay % {sector} trusts {year}",
            "WARNING",
            f"pay_pct BETWEEN {p_lo} AND {p_hi}",
            _text("pay_pct", f"% (NHS benchmark {p_lo}–{p_hi}%)"),
        ),
        _named_check(
            "unbalanced",
            "income - expenditure = operating surplus",
            "WARNING",
            "unbalanced = 0",
            _text("unbalanced", " trust-years where I&E doesn't balance (tolerance £1m)"),
        ),
        _named_check(
            "implausible",
            f"WTE values plausible (0 < WTE ≤ {WTE_MAX:,})",
            "WARNING",
            "implausible = 0",
            _text("implausible", " trust-years with implausible WTE"),
        ),
    ]
    return _Checks(fact.sparkSession, lambda: years_of(dim_trust).agg(*named(metrics)), alone, checks)


REPORT_SCHEMA = "check_name string, severity string, passed boolean, detail string"


def _guarded(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A check that cannot be planned (a missing column, say) becomes a failed CRITICAL row."""
    try:
        return build()
    except AnalysisException as error:
        detail = f"Exception: {error.getCondition()}"
        return spark.createDataFrame([(name, "CRITICAL", False, detail)], REPORT_SCHEMA)


def audit_report(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, expected: dict = EXPECTED) -> DataFrame:
    """One row per check: name, severity, passed, detail. Lazy; ``run_report`` also keeps what is left when a check fails while it runs."""
    return reduce(DataFrame.unionByName, (group.together() for group in _groups(fact, dim_trust, dim_subcode, expected)))


def _groups(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, expected: dict) -> list[_Checks]:
    return [_key_checks(fact, dim_trust, expected), _trust_count(dim_trust, expected), _view_checks(fact, dim_trust, dim_subcode, expected)]


def run_report(fact: DataFrame, dim_trust: DataFrame, dim_subcode: DataFrame, expected: dict = EXPECTED) -> DataFrame:
    """The report, run: a row for every check, whatever happens to it. A check that fails while it runs is a failed CRITICAL row.

    The checks of a group run together; only if that fails is each of them run alone. The rows are as few as the checks.
    """
    spark, rows = fact.sparkSession, []
    for group in _groups(fact, dim_trust, dim_subcode, expected):
        try:
            rows += group.together().collect()
        except PySparkException:
            for name, build in group.alone():
                try:
                    rows += build().collect()
                except PySparkException as error:
                    rows.append((name, "CRITICAL", False, f"Exception: {error.getCondition() or type(error).__name__}"))
    return spark.createDataFrame([tuple(row) for row in rows], REPORT_SCHEMA)


def has_critical_failure(report: DataFrame) -> bool:
    """True if the pipeline should stop."""
    return not report.filter((F.col("severity") == "CRITICAL") & ~F.col("passed")).isEmpty()


def preload_audit(raw_lines: DataFrame, providers: DataFrame) -> DataFrame:
    """Gate before a load, per source file, on the lines as published: what cleaning would drop or change is counted.

    Missing values and totals that do not fit are CRITICAL; unreadable totals, duplicates and unlisted names among the lines that
    cleaning keeps warn. Lines are grouped by (file, organisation, main code, sub code) first, so a hot organisation shrinks to
    its distinct codes before anything is compared.
    """
    file = ["source_file", "financial_year", "trust_type"]
    kept = "organisation_name IS NOT NULL AND sub_code IS NOT NULL AND NOT no_total AND NOT too_large"
    faults = {
        "no_name": "organisation_name IS NULL", "no_code": "sub_code IS NULL", "no_total": "no_total",
        "no_year": "financial_year IS NULL", "unreadable": "unreadable", "too_large": "too_large",
    }
    counts = {"n": f"count_if({kept})"} | {f"{k}_n": f"count_if({v})" for k, v in faults.items()}
    sums = {f"{k}_n": f"sum({k}_n)" for k in faults}
    listed = providers.selectExpr(
        "financial_year", "trust_type", "lower(organisation_name) AS name_key", "1 AS listed"
    ).distinct()
    names = (
        inspected_lines(raw_lines)
        .groupBy(*file, "organisation_name", "main_code", "sub_code")
        .agg(*named(counts))
        .selectExpr("*", "lower(organisation_name) AS name_key")
        .groupBy(*file, "name_key")
        .agg(*named({"n": "sum(n)", "dupes": "sum(greatest(n - 1, 0))"} | sums))
        .join(listed, ["financial_year", "trust_type", "name_key"], "left")
    )
    files = names.groupBy("source_file").agg(
        *named({"dupes": "sum(dupes)", "unlisted": "count_if(n > 0 AND listed IS NULL)"} | sums)
    )
    gates = [
        ("nulls in organisation_name", "CRITICAL", "no_name_n"),
        ("nulls in sub_code", "CRITICAL", "no_code_n"),
        ("nulls in total", "CRITICAL", "no_total_n"),
        ("nulls in financial_year", "CRITICAL", "no_year_n"),
        ("totals that do not fit", "CRITICAL", "too_large_n"),
        ("unreadable totals", "WARNING", "unreadable_n"),
        ("duplicate (org, main_code, sub_code) rows", "WARNING", "dupes"),
        ("organisation names not in provider list", "WARNING", "unlisted"),
    ]
    checks = ", ".join(
        f"struct('{name}' AS check_name, '{severity}' AS severity, {count} AS failures, {count} = 0 AS passed)"
        for name, severity, count in gates
    )
    return files.selectExpr("source_file", f"inline(array({checks}))")


def final_counts(fact: DataFrame, dim_trust: DataFrame) -> DataFrame:
    """Row counts of the two loaded tables."""
    trusts = dim_trust.agg(*named({"table_name": "'dim_trust'", "row_count": "count(*)"}))
    facts = fact.agg(*named({"table_name": "'fct_tac'", "row_count": "count(*)"}))
    return trusts.unionByName(facts)


# --- validation reports ------------------------------------------------------------------------------


def rows_by_year_type(fact: DataFrame) -> DataFrame:
    """Organisations and lines; lines are counted per organisation first."""
    orgs = fact.groupBy("financial_year", "trust_type", "org_code").agg(F.count(F.lit(1)).alias("n"))
    return (
        orgs.groupBy("financial_year", "trust_type")
        .agg(*named({"providers": "count(org_code)", "total_rows": "sum(n)"}))
        .orderBy("financial_year", "trust_type")
    )


def patient_income_by_year(fact: DataFrame, sub_code: str = "SCI0100A") -> DataFrame:
    orgs = (
        fact.filter(F.col("sub_code") == sub_code)
        .groupBy("financial_year", "org_code")
        .agg(*named({"total": "sum(CAST(total_000s AS BIGINT))"}))
    )
    columns = {"patient_income_bn": total_bn("total"), "providers": "count(org_code)"}
    return orgs.groupBy("financial_year").agg(*named(columns)).orderBy("financial_year")


def income_expenditure_by_year(income: DataFrame) -> DataFrame:
    columns = {
        "patient_income_bn": total_bn("patient_care_income_000s"),
        "other_income_bn": total_bn("other_income_000s"),
        "total_income_bn": total_bn("total_income_000s"),
        "total_exp_bn": total_bn("total_expenditure_000s"),
        "op_surplus_bn": total_bn("operating_surplus_000s"),
        "providers": "count(org_code)",
    }
    return income.groupBy("financial_year").agg(*named(columns)).orderBy("financial_year")


def kpis_by_sector(kpis: DataFrame, year: str) -> DataFrame:
    columns = {
        "providers": "count(org_code)",
        "avg_ebitda_margin_pct": expr.mean("ebitda_margin_pct"),
        "avg_pay_pct_income": expr.mean("pay_pct_income"),
        "avg_net_surplus_pct": expr.mean("net_surplus_margin_pct"),
    }
    return (
        in_year(kpis, year)
        .filter("total_income_000s > 0")
        .groupBy("sector", "trust_type")
        .agg(*named(columns))
        .orderBy("sector", "trust_type")
    )


def deficit_split(income: DataFrame, year: str) -> DataFrame:
    def total(condition: str) -> str:
        part = f"CASE WHEN operating_surplus_000s {condition} THEN operating_surplus_000s ELSE 0 END"
        return total_m(part, 1)

    columns = {
        "deficit_trusts": "count_if(operating_surplus_000s < 0)",
        "surplus_trusts": "count_if(operating_surplus_000s >= 0)",
        "total_trusts": "count(*)",
        "total_deficit_m": total("< 0"),
        "total_surplus_m": total(">= 0"),
    }
    return in_year(income, year).agg(*named(columns))


def _best(kpis: DataFrame, order: Column, limit: int, margin: str, name: str) -> DataFrame:
    return (
        kpis.orderBy(order, "org_code")
        .limit(limit)
        .selectExpr(
            "org_code",
            "organisation_name",
            "sector",
            "trust_type",
            f"{expr.scaled('total_income_000s', MILLION, 1)} AS total_income_m",
            f"{expr.scaled('operating_surplus_000s', MILLION, 1)} AS op_surplus_m",
            f"CAST({margin} AS DOUBLE) AS {name}",
        )
    )


def largest_income(kpis: DataFrame, year: str, limit: int = 10) -> DataFrame:
    return _best(in_year(kpis, year), F.desc("total_income_000s"), limit, "net_surplus_margin_pct", "net_margin")


def largest_deficit(kpis: DataFrame, year: str, limit: int = 10) -> DataFrame:
    known = in_year(kpis, year).filter("operating_surplus_000s IS NOT NULL")
    return _best(known, F.asc("operating_surplus_000s"), limit, "ebitda_margin_pct", "ebitda_margin")


def pay_and_drugs_by_year(breakdown: DataFrame) -> DataFrame:
    columns = {
        "total_pay_bn": total_bn("pay_000s"),
        "total_drugs_bn": total_bn("drugs_cost_000s"),
        "total_non_pay_bn": total_bn("non_pay_000s"),
        "total_exp_bn": total_bn("total_expenditure_000s"),
        "pay_pct_exp": expr.weighted_pct("pay_000s", "total_expenditure_000s"),
    }
    return breakdown.groupBy("financial_year").agg(*named(columns)).orderBy("financial_year")


def workforce_by_year(workforce: DataFrame) -> DataFrame:
    """Cost per WTE stays in £000."""
    columns = {
        "total_wte": "sum(total_wte)",
        "staff_cost_bn": total_bn("total_staff_cost_000s"),
        "avg_cost_per_wte_k": expr.ratio("sum(total_staff_cost_000s)", "sum(total_wte)"),
    }
    return (
        workforce.filter("total_wte IS NOT NULL")
        .groupBy("financial_year")
        .agg(*named(columns))
        .orderBy("financial_year")
    )


def key_uniqueness(fact: DataFrame) -> DataFrame:
    """Rows against distinct keys, counted by key first."""
    keys = fact.groupBy(*FACT_KEY).agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(*named({"total_rows": "coalesce(sum(n), 0)", "unique_keys": "count(*)"}))
