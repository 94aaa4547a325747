"""Results do not depend on how Spark joins and partitions, and hot keys change nothing."""

from contextlib import contextmanager

import pytest
from compare import spark_rows

import __spark_entry__ as entry
from provfin.operators import merge
from provfin.plans import monthly
from provfin.sources import fixture as fx


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("key", ["scorecard", "fact_promote", "income_detail", "audit_report", "size_bands", "m_yoy"])
def test_large_dimension_path_gives_the_same_rows(key, spark, sf_dir):
    usual = spark_rows(entry.queries()[key](spark, sf_dir))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="13",
    ):
        assert spark_rows(entry.queries()[key](spark, sf_dir)) == usual


def test_hot_organisation_is_shuffled_as_aggregates(spark, sf_dir):
    """Between scan and first shuffle there is a partial aggregation on the organisation-year."""
    plan = entry.queries()["scorecard"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    lines = [ln.strip(" +-:*") for ln in plan.splitlines()]
    scan = next(i for i, ln in enumerate(lines) if "lineitem.parquet" in ln)
    shuffle = max(i for i, ln in enumerate(lines[:scan]) if "Exchange hashpartitioning" in ln)
    assert any("HashAggregate" in ln and "partial_sum" in ln for ln in lines[shuffle:scan])


def test_promote_with_one_organisation_holding_most_lines(spark):
    hot = spark.range(20_000).selectExpr(
        "'2023/24' AS financial_year", "'NHS_TRUST' AS trust_type",
        "CASE WHEN id % 10 < 9 THEN 'Hot' ELSE concat('Org ', id % 50) END AS organisation_name",
        "'A08CY01' AS main_code", "concat('c', id % 7) AS sub_code", "'f' AS source_file", "id AS row_num",
        "id AS total", "'TAC08 Op Exp' AS worksheet_name", "CAST(1 AS SMALLINT) AS table_id",
    )
    listed = hot.selectExpr(
        "financial_year", "trust_type", "organisation_name", "substr(md5(organisation_name), 1, 3) AS org_code"
    ).distinct()
    out = merge.promote_lines(hot, listed)
    exact = hot.groupBy("organisation_name", "sub_code").max("total").join(listed, "organisation_name")
    expected = {(r.org_code, r.sub_code, r[2]) for r in exact.collect()}
    assert {(r.org_code, r.sub_code, int(r.total_000s)) for r in out.collect()} == expected


def returns(spark, rows):
    return spark.createDataFrame(
        rows,
        "org_code string, financial_year string, period string, account_type string, subjective_code string, "
        "data_type string, amount_000s bigint",
    )


def test_statuses_follow_unrounded_numbers(spark):
    cip = lambda a, b: monthly.cip_achievement(returns(spark, [month("CIP", "ACTUAL", a), month("CIP", "BUDGET", b)])).first()
    assert [(cip(a, 10000).cip_achievement_pct, cip(a, 10000).cip_rag) for a in (10000, 9996, 8000, 7996)] == [
        (100.0, "Green"), (100.0, "Amber"), (80.0, "Amber"), (80.0, "Red")]
    agency = lambda g: monthly.agency_share(returns(spark, [month("PAY", "ACTUAL", 10000 - g), month("NON_PAY", "ACTUAL", g, code="AGENCY")])).first()
    assert [(agency(g).agency_pct, agency(g).over_ceiling) for g in (350, 345, 349)] == [(3.5, 1), (3.5, 0), (3.5, 0)]
    capital = lambda a: monthly.capital_share(returns(spark, [month("CAPITAL", "ACTUAL", a), month("CAPITAL", "BUDGET", 10000)])).first()
    assert [capital(a).capital_rag for a in (8996, 9000, 11000, 11004, 7500, 7496)] == ["Amber", "Green", "Green", "Red", "Amber", "Red"]
    variance = lambda kind, a: monthly.budget_variance(returns(spark, [month(kind, "ACTUAL", a), month(kind, "BUDGET", 10000)])).first()
    assert [(variance("INCOME", a).direction, variance("INCOME", a).variance_rag) for a in (10000, 9998, 9800, 9796)] == [
        ("FAV", "Green"), ("ADV", "Amber"), ("ADV", "Amber"), ("ADV", "Red")]
    assert variance("PAY", 10002).variance_rag == "Amber" and variance("PAY", 10204).variance_rag == "Red"


def month(kind, side, amount, period="M01", code="GENERAL"):
    return ("A", "2023/24", period, kind, code, side, amount)


@pytest.mark.parametrize("actual, status", [(74, "Red"), (75, "Amber"), (90, "Green"), (110, "Green"), (111, "Red")])
def test_capital_status(spark, actual, status):
    rows = returns(spark, [month("CAPITAL", "ACTUAL", actual), month("CAPITAL", "BUDGET", 100)])
    assert monthly.capital_share(rows).first().capital_rag == status


@pytest.mark.parametrize("actual, status", [(79, "Red"), (80, "Amber"), (100, "Green"), (None, "Grey")])
def test_savings_status(spark, actual, status):
    rows = [month("CIP", "BUDGET", 100)] + ([] if actual is None else [month("CIP", "ACTUAL", actual)])
    assert monthly.cip_achievement(returns(spark, rows)).first().cip_rag == status


def test_agency_share(spark):
    row = monthly.agency_share(
        returns(spark, [month("PAY", "ACTUAL", 965), month("NON_PAY", "ACTUAL", 35, code="AGENCY")])
    ).first()
    assert (row.agency_pct, row.over_ceiling) == (3.5, 1)


@pytest.mark.parametrize(
    "kind, actual, direction, status",
    [
        ("INCOME", 100, "FAV", "Green"), ("INCOME", 98, "ADV", "Amber"), ("INCOME", 97, "ADV", "Red"),
        ("PAY", 100, "FAV", "Green"), ("PAY", 102, "ADV", "Amber"), ("PAY", 103, "ADV", "Red"), ("PAY", 90, "FAV", "Green"),
    ],
)
def test_variance_signs(spark, kind, actual, direction, status):
    row = monthly.budget_variance(returns(spark, [month(kind, "ACTUAL", actual), month(kind, "BUDGET", 100)])).first()
    assert (row.direction, row.variance_rag) == (direction, status)


def test_year_to_date(spark):
    rows = [month("PAY", s, a, p) for p, a in (("M01", 5), ("M02", 7), ("M12", 1)) for s in ("ACTUAL", "BUDGET")]
    out = {r.period: r.ytd_actual_000s for r in monthly.budget_variance(returns(spark, rows)).collect()}
    assert out == {"M01": 5, "M02": 12, "M12": 13}


def test_fact_key_is_unique_with_prior_year_lines(spark, sf_dir):
    facts = fx.facts(spark, sf_dir, include_prior=True)
    assert facts.groupBy(*merge.FACT_KEY).count().filter("count > 1").count() == 0


@pytest.mark.parametrize("key", ["kpis_fractional", "workforce_fractional", "scorecard_from_files", "national_trend_from_files"])
def test_cleaning_of_published_accounts_is_compiled(key, spark, sf_dir):
    """Texts of a published line are written out once; the generated method that cleans them stays below 8,000 bytes, else the JVM interprets it."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    with settings(spark, spark__sql__adaptive__enabled="false"):
        plan = entry.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan()
        stages = debug.codegenStringSeq(plan)
    cleaning = [s for s in map(stages.apply, range(stages.size())) if "DecimalFormat" in s._2()]
    assert len(cleaning) == 1
    assert cleaning[0]._3().maxMethodCodeSize() < 8000


def _texts_written(spark, sf_dir, run) -> list[int]:
    """Lines for which the plans that ``run`` executes have written texts out, in order, by the rows that reach the one-element array."""
    seen, whole = [], fx._unfolded

    def counted(rows, columns):
        seen.append(rows.count())
        return whole(rows, columns)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(fx, "_unfolded", counted)
        run()
    return seen


def test_replaced_year_is_chosen_before_its_texts_are_written(spark, sf_dir):
    whole = fx.raw_lines(spark, sf_dir).count()
    seen = _texts_written(spark, sf_dir, lambda: entry.queries()["stg_replace"](spark, sf_dir))
    assert seen[0] == whole and len(seen) == 3
    assert max(seen[1:]) < whole / 3


@pytest.mark.parametrize("key", ["final_counts", "dim_trust_build"])
def test_provider_lists_of_all_years_come_from_one_scan(key, spark, sf_dir):
    """Lists of the earlier and the later years have one reading of the lines between them, without a file name for each line."""
    with settings(spark, spark__sql__adaptive__enabled="false"):
        plan = entry.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    years = [ln for ln in plan.splitlines() if "FileScan" in ln and "lineitem.parquet" in ln and "l_extendedprice" not in ln]
    assert len(years) == 1
    assert "ReusedExchange" in plan


def test_published_lines_are_chosen_before_their_texts_are_written(spark, sf_dir):
    whole = fx.raw_lines(spark, sf_dir).count()
    seen = _texts_written(spark, sf_dir, lambda: entry.queries()["fact_from_stream"](spark, sf_dir))
    lines = [n for n in seen if n > 0]
    assert len(lines) == 3  # one reading of the provider lists, and the lines of each of the two publications
    assert lines[1] + lines[2] == whole


def test_late_facts_of_a_refresh_are_derived_once(spark, sf_dir, monkeypatch):
    from provfin.registry import queries

    plans, promote = [], queries.sinks.promote_into

    def seen(path, incoming, *years):
        plans.append(incoming._jdf.queryExecution().optimizedPlan().toString())
        promote(path, incoming, *years)

    monkeypatch.setattr(queries.sinks, "promote_into", seen)
    entry.queries()["scorecard_refresh"](spark, sf_dir)
    assert len(plans) == 2
    assert "l_extendedprice" in plans[0] and "l_extendedprice" not in plans[1]
