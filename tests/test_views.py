"""Hand-written accounts: missing schedules, zero income, boundary margins, and the one-pass scorecard."""

from decimal import Decimal

import pytest

from provfin import refdata
from provfin.plans import audit, benchmark, enrich, measures, trend, views

FACT = (
    "org_code string, financial_year string, worksheet_name string, table_id smallint, main_code string, "
    "sub_code string, total_000s decimal(14,0), trust_type string, source_file string"
)
TRUST = (
    "org_code string, organisation_name string, trust_type string, sector string, region string, is_foundation int, "
    "first_year_seen string, last_year_seen string"
)
SOCI, EXP, STAFF, INC = refdata.WS_SOCI, refdata.WS_EXPENDITURE, refdata.WS_STAFF, refdata.WS_PATIENT_INCOME


def fact(spark, rows):
    """rows: (org, year, worksheet, sub_code, total[, main_code])"""
    data = [
        (r[0], r[1], r[2], 1, r[5] if len(r) > 5 else f"A{r[2][3:5]}CY01", r[3], Decimal(r[4]), "NHS_TRUST", "f")
        for r in rows
    ]
    return spark.createDataFrame(data, FACT)


def trusts(spark, *orgs, sectors=None):
    sectors = sectors or {}
    return spark.createDataFrame(
        [(o, f"Org {o}", "NHS_TRUST", sectors.get(o, "Acute"), "North", 0, None, None) for o in orgs], TRUST
    )


def accounts(org, year, income, surplus, net=None, depreciation=None, pay=None, wte=None):
    rows = [(org, year, SOCI, "SCI0100A", income), (org, year, SOCI, "SCI0140A", surplus)]
    rows.append((org, year, SOCI, "SCI0125A", -(income - surplus)))
    if net is not None:
        rows.append((org, year, SOCI, "SCI0240", net))
    if depreciation is not None:
        rows.append((org, year, EXP, "EXP0240", depreciation))
    if pay is not None:
        rows.append((org, year, EXP, "EXP0130", pay))
    if wte is not None:
        rows.append((org, year, STAFF, "STA0410", wte))
    return rows


def one(df, **where):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in where.items())]
    assert len(rows) == 1
    return rows[0]


@pytest.fixture(scope="module")
def mixed(spark):
    """Organisations that lack schedules, have unseeded or repeated codes, or no income."""
    rows = [
        *accounts("AAA", "2023/24", 1000, 50, 20, depreciation=30, pay=600, wte=40),
        ("AAA", "2023/24", STAFF, "STA0410", 35, "A09CY01P"),
        ("AAA", "2023/24", EXP, "EXP0130", 7, "A08CY02"),
        *accounts("NO8", "2023/24", 1000, 10, 5, wte=10),
        *accounts("NO9", "2023/24", 1000, 10, 5, pay=500),
        ("NO2", "2023/24", EXP, "EXP0130", 400),
        ("NO2", "2023/24", STAFF, "STA0410", 9),
        *accounts("NIL", "2023/24", 0, -10, -10),
        *accounts("NOP", "2023/24", 1000, 10, 5),
        ("NOP", "2023/24", EXP, "EXP0170", 80),
        *accounts("UNS", "2023/24", 1000, 10, 5),
        ("UNS", "2023/24", EXP, "ZZZ9999", 80),
        ("ONE", "2023/24", SOCI, "SOC0190", 1),
        *accounts("ORP", "2023/24", 1000, 10, 5),
        ("AAA", "2023/24", INC, "INC0330", 12),
        ("AAA", "2023/24", "TAC99 Other", "INC0330", 15),
    ]
    orgs = ["AAA", "NO8", "NO9", "NO2", "NIL", "NOP", "UNS", "ONE"]
    return fact(spark, rows), trusts(spark, *orgs), refdata.dim_subcode(spark)


def test_income_view_rows_follow_the_summary_schedule(mixed):
    f, t, _ = mixed
    rows = {r.org_code: r for r in views.income_expenditure(f, t).collect()}
    assert set(rows) == {"AAA", "NO8", "NO9", "NIL", "NOP", "UNS", "ONE"}
    assert rows["ONE"].total_income_000s == 0 and rows["ONE"].operating_surplus_000s is None
    assert rows["AAA"].total_expenditure_000s == 950


def test_expenditure_view_sums_all_columns_and_needs_seeded_codes(mixed):
    f, t, c = mixed
    rows = {r.org_code: r for r in views.expenditure_breakdown(f, t, c).collect()}
    assert rows["AAA"].pay_000s == 607 and rows["AAA"].staff_cost_000s == 600
    assert rows["NOP"].pay_000s == 0
    assert "UNS" not in rows and "NO8" not in rows


def test_kpis_keep_missing_apart_from_zero(mixed):
    rows = {r.org_code: r for r in views.kpis(*mixed).collect()}
    assert set(rows) == {"AAA", "NO8", "NO9", "NOP", "UNS"}
    assert rows["NO8"].pay_000s is None and rows["UNS"].pay_000s is None and rows["NOP"].pay_000s == 0
    assert rows["NO9"].total_wte is None and rows["NO9"].cost_per_wte_000s is None
    assert float(rows["AAA"].ebitda_margin_pct) == 8.0 and float(rows["AAA"].cost_per_wte_000s) == 15.0


def test_one_pass_scorecard_equals_the_composed_views(mixed):
    f, t, c = mixed
    v1, v2, v3 = views.income_expenditure(f, t), views.expenditure_breakdown(f, t, c), views.workforce(f, t)
    keys = ["org_code", "financial_year"]
    composed = (
        v1.filter("total_income_000s > 0")
        .select(*keys, "total_income_000s", "total_expenditure_000s", "net_surplus_000s")
        .join(v2.select(*keys, "pay_000s", "non_pay_000s", "depreciation_amort_000s", "staff_cost_000s"), keys, "left")
        .join(v3.select(*keys, "total_wte", "total_staff_cost_000s"), keys, "left")
    )
    card = views.scorecard(f, t, c).select(*composed.columns)
    assert sorted(map(str, card.collect())) == sorted(map(str, composed.collect()))
    assert one(views.scorecard(f, t, c), org_code="AAA").private_patient_income_000s == 15


@pytest.mark.parametrize(
    "surplus, status", [(0, "Red"), (19, "Red"), (20, "Amber"), (49, "Amber"), (50, "Green"), (-5, "Red")]
)
def test_margin_status_boundaries(spark, surplus, status):
    f = fact(spark, accounts("AAA", "2023/24", 1000, surplus, 0))
    assert views.kpis(f, trusts(spark, "AAA"), refdata.dim_subcode(spark)).first().ebitda_rag == status


@pytest.mark.parametrize(
    "net, kpi_status, card_status",
    [(0, "Green", "Amber"), (1, "Green", "Green"), (-200, "Amber", "Red"), (-201, "Red", "Red"), (None, "Grey", "Grey")],
)
def test_surplus_status_boundaries(spark, net, kpi_status, card_status):
    f = fact(spark, accounts("AAA", "2023/24", 10_000, 100, net))
    t, c = trusts(spark, "AAA"), refdata.dim_subcode(spark)
    assert views.kpis(f, t, c).first().surplus_rag == kpi_status
    assert views.scorecard(f, t, c).first().surplus_rag == card_status


def card_of(spark, rows, sectors=None):
    orgs = sorted({r[0] for r in rows})
    return views.scorecard(fact(spark, rows), trusts(spark, *orgs, sectors=sectors), refdata.dim_subcode(spark))


def test_margin_of_two_counts_in_both_buckets(spark):
    row = trend.ebitda_distribution(card_of(spark, accounts("AAA", "2023/24", 1000, 20)), "2023/24").first()
    assert (row.low_0_2, row.mid_2_5) == (1, 1)


def test_unknown_sector_threshold(spark):
    card = card_of(spark, accounts("AAA", "2023/24", 1000, 20, pay=660), {"AAA": "Other"})
    assert benchmark.pay_pressure(card, "2023/24").first().excess_pp == 1.0
    assert enrich.trust_flags(card).first().pay_pressure_flag == 0


def test_gap_year_lag_and_exact_pairs(spark):
    rows = accounts("AAA", "2021/22", 1000, 20) + accounts("AAA", "2023/24", 1000, 50)
    card = card_of(spark, rows)
    latest = one(enrich.yoy_ebitda(card), financial_year="2023/24")
    assert float(latest.ebitda_margin_yoy_pp) == 3.0
    assert benchmark.ebitda_movers(card, "2023/24", "2022/23").count() == 0
    yearly = one(measures.yoy(card), financial_year="2023/24")
    assert yearly.prior_year == "2022/23" and yearly.ebitda_margin_yoy_pp is None
    assert yearly.prior_year_income_m == 0.0 and yearly.income_yoy_growth_pct is None


def test_year_slicer_still_sees_the_prior_year(spark):
    rows = accounts("AAA", "2022/23", 1000, 20) + accounts("AAA", "2023/24", 1100, 50)
    shown = measures.yoy(card_of(spark, rows), filters={"financial_year": ["2023/24"]}).collect()
    assert [r.financial_year for r in shown] == ["2023/24"]
    assert round(shown[0].income_yoy_growth_pct, 6) == 10.0


def test_ties_at_the_cut_share_a_rank(spark):
    rows = []
    for i in range(6):
        rows += accounts(f"A{i:02d}", "2023/24", 900 if i < 2 else 1000, 20)
    top = trend.top_income(card_of(spark, rows), "2023/24", limit=5).collect()
    assert [(r.org_code, r["rank"]) for r in top] == [
        ("A02", 1), ("A03", 1), ("A04", 1), ("A05", 1), ("A00", 5),
    ]


@pytest.mark.parametrize("n", [1, 3, 5, 8, 41])
def test_quartiles_match_ntile(spark, n):
    rows = []
    for i in range(n):
        rows += accounts(f"A{i:02d}", "2023/24", 1000 + (i * 7) % 5, 20)
    banded = benchmark.size_bands(card_of(spark, rows), "2023/24").collect()
    base, extra = divmod(n, 4)
    sizes = [base + 1] * extra + [base] * (4 - extra)
    assert [r.trust_count for r in banded] == [s for s in sizes if s]


def test_empty_selection(spark):
    card = card_of(spark, accounts("AAA", "2023/24", 1000, 20))
    none = {"sector": ["Nowhere"]}
    assert measures.core(card, [], none).first().total_income_m == 0.0
    assert measures.kpi(card, [], none).first().ebitda_margin_pct is None
    assert measures.rag(card, [], none).first().ebitda_rag == "Grey"
    assert measures.labels(card, [], none).first().selected_year == "All Years"


def test_benchmark_without_axes(spark):
    card = card_of(spark, accounts("AAA", "2023/24", 1000, 20))
    row = measures.benchmark(card, []).first()
    assert row.sector_benchmark_ebitda_pct == 2.0 and abs(row.ebitda_vs_benchmark_pp) < 1e-9


def test_audit_reports_failures(spark):
    good = fact(spark, accounts("AAA", "2023/24", 1000, 20, pay=600, wte=50_000))
    rules = {**refdata.EXPECTED, "fact_row_min": 1, "trust_count_min": 1}
    t, c = trusts(spark, "AAA"), refdata.dim_subcode(spark)

    def result(f):
        return {r.check_name: r.passed for r in audit.audit_report(f, t, c, rules).collect()}

    passed = result(good)
    assert passed["fct_tac row count"] and passed["no duplicate fact keys"] and not passed["year coverage: 2022/23"]
    assert passed["WTE values plausible (0 < WTE ≤ 50,000)"] and passed["income - expenditure = operating surplus"]
    bad = fact(
        spark,
        [
            *accounts("AAA", "2023/24", 5000, 20, wte=50_001),
            ("AAA", "2023/24", SOCI, "SCI0100A", 9999),
            *accounts("ZZZ", "2023/24", 10, 1),
        ],
    )
    failed = result(bad)
    assert not failed["no duplicate fact keys"] and not failed["no orphan org_codes in fct_tac"]
    assert not failed["WTE values plausible (0 < WTE ≤ 50,000)"]
    assert not failed["income - expenditure = operating surplus"]
    report = audit.audit_report(bad, t, c, rules)
    assert audit.has_critical_failure(report)
    names = {r.check_name for r in audit.audit_report(good, t, c, rules).collect()}
    for column in good.columns:
        broken = {r.check_name: r for r in audit.audit_report(good.drop(column), t, c, rules).collect()}
        assert set(broken) == names, column
        lost = {n for n, r in broken.items() if r.detail.startswith("Exception")}
        keyed, yearly = {"no duplicate fact keys"}, {n for n in names if n.startswith("year coverage")}
        orgs = {"no null org_codes in fct_tac", "no orphan org_codes in fct_tac"}
        views = {n for n in names if n not in {*keyed, *yearly, *orgs, "fct_tac row count", "dim_trust row count"}}
        wanted = {
            "org_code": keyed | orgs | views, "financial_year": keyed | yearly | views, "sub_code": keyed | views,
            "main_code": keyed, "worksheet_name": views, "total_000s": views,
        }
        assert lost == wanted.get(column, set()), column
    broken = audit.audit_report(good, t.drop("sector"), c, rules).filter("detail LIKE 'Exception%'").collect()
    assert [r.check_name for r in broken] == [n for n in names if n.startswith("avg pay %")]


@pytest.mark.parametrize("off, passed", [(1000, True), (1001, False)])
def test_balance_tolerance(spark, off, passed):
    rows = accounts("AAA", "2023/24", 5000, 20)
    rows[1] = ("AAA", "2023/24", SOCI, "SCI0140A", 20 + off)
    report = audit.audit_report(fact(spark, rows), trusts(spark, "AAA"), refdata.dim_subcode(spark))
    assert one(report, check_name="income - expenditure = operating surplus").passed is passed


def test_sector_labels(spark):
    rows = spark.createDataFrame([("MENTAL_HEALTH",), ("Other",), (None,)], "sector string")
    assert {r.sector for r in enrich.normalise_sectors(rows).collect()} == {"Mental Health", "Other", None}


def test_scorecard_reads_the_fact_once(spark, sf_dir):
    from provfin.registry.queries import queries

    card = queries()["scorecard"](spark, sf_dir)
    card.collect()
    plan = card._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("lineitem.parquet") == 1
    # The dimension is broadcast because its measured size allows it, not by a hint.
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final and "CartesianProduct" not in final


def test_year_reports_skip_other_years_at_the_scan(spark, sf_dir):
    from provfin.registry.queries import queries

    plan = queries()["sector_kpis"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
