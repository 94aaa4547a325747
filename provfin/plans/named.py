"""The views under their names in SQL, and the reports as table functions with parameters.

``register`` makes temporary views of the given frames and one SQL function per report, so that a user asks
``SELECT * FROM top_income(:year)`` with bound values. A function is a query that Spark puts in place of the call: a year given as an
argument is a predicate like any other and prunes partitions of stored facts; values are never pasted into text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from provfin.functions import expr
from provfin.plans.benchmark import DEFICITS, total_m
from provfin.plans.trend import MILLION, STATUS


def _first(view: str, order: str, limit: int) -> str:
    """The first rows of a year; the limit comes before any ranking, so ranks are of few rows."""
    return f"(SELECT * FROM {view} WHERE financial_year = year ORDER BY {order}, org_code LIMIT {int(limit)})"


def functions(limit: int = 20) -> dict[str, tuple[str, str, str]]:
    """Function: its parameters, its columns, and its query over the view ``scorecard``."""
    about = "org_code STRING, organisation_name STRING, sector STRING, region STRING"
    income = f"{expr.scaled('total_income_000s', MILLION, 0)} AS income_m"
    margin = "CAST(ebitda_margin_pct AS DOUBLE) AS ebitda_margin"
    in_year = "FROM scorecard WHERE financial_year = year"
    return {
        "top_income": (
            "year STRING",
            f"rank INT, {about}, income_m DOUBLE, op_surplus_m DOUBLE, ebitda_margin DOUBLE, pay_pct DOUBLE, status STRING",
            f"""SELECT rank() OVER (ORDER BY total_income_000s DESC), org_code, organisation_name, sector, region, {income},
                {expr.scaled('operating_surplus_000s', MILLION, 0)}, {margin}, CAST(pay_pct_income AS DOUBLE), {STATUS}
                FROM {_first('scorecard', 'total_income_000s DESC', limit)}""",
        ),
        "worst_net_margin": (
            "year STRING",
            f"deficit_rank INT, {about}, trust_type STRING, income_m DOUBLE, net_surplus_m DOUBLE, net_margin DOUBLE, ebitda_margin DOUBLE",
            f"""SELECT rank() OVER (ORDER BY net_surplus_margin_pct NULLS FIRST), org_code, organisation_name, sector, region, trust_type, {income},
                {expr.scaled('net_surplus_000s', MILLION, 0)}, CAST(net_surplus_margin_pct AS DOUBLE), {margin}
                FROM {_first('scorecard', 'net_surplus_margin_pct NULLS FIRST', limit)}""",
        ),
        "sector_kpis": (
            "year STRING",
            """sector STRING, trust_type STRING, providers BIGINT, total_income_m DOUBLE, avg_ebitda_pct DOUBLE, avg_pay_pct DOUBLE,
               avg_net_surplus_pct DOUBLE, deficit_count BIGINT, total_deficit_m DOUBLE""",
            f"""SELECT sector, trust_type, count(*), {total_m('total_income_000s')}, {expr.mean('ebitda_margin_pct')}, {expr.mean('pay_pct_income')},
                {expr.mean('net_surplus_margin_pct')}, {DEFICITS},
                {total_m('CASE WHEN operating_surplus_000s < 0 THEN operating_surplus_000s ELSE 0 END')} {in_year} GROUP BY sector, trust_type""",
        ),
        "regional_health": (
            "year STRING",
            """region STRING, trusts BIGINT, total_income_m DOUBLE, total_surplus_m DOUBLE, sector_op_margin_pct DOUBLE, avg_ebitda_pct DOUBLE,
               avg_pay_pct DOUBLE, deficit_trusts BIGINT, deficit_pct DOUBLE""",
            f"""SELECT region, count(org_code), {total_m('total_income_000s')}, {total_m('operating_surplus_000s')},
                {expr.weighted_pct('operating_surplus_000s', 'total_income_000s')}, {expr.mean('ebitda_margin_pct')}, {expr.mean('pay_pct_income')},
                {DEFICITS}, {expr.pct('sum(is_deficit)', 'count(*)', 0)} {in_year} AND region IS NOT NULL GROUP BY region""",
        ),
        "sector_members": (
            "chosen STRING, year STRING",
            "org_code STRING, organisation_name STRING, region STRING, total_income_000s BIGINT, is_deficit INT",
            f"SELECT org_code, organisation_name, region, total_income_000s, is_deficit {in_year} AND sector = chosen",
        ),
        "ebitda_change": (
            "year STRING, prior STRING",
            "org_code STRING, organisation_name STRING, ebitda_prior_pct DOUBLE, ebitda_current_pct DOUBLE, yoy_change_pp DOUBLE",
            """SELECT org_code, organisation_name, CAST(max(was) AS DOUBLE), CAST(max(became) AS DOUBLE), CAST(max(became) - max(was) AS DOUBLE) FROM (
                 SELECT org_code, organisation_name, CASE WHEN financial_year = prior THEN ebitda_margin_pct END AS was,
                   CASE WHEN financial_year = year THEN ebitda_margin_pct END AS became
                 FROM scorecard WHERE financial_year IN (year, prior)) GROUP BY org_code, organisation_name HAVING count(*) = 2""",
        ),
    }


def register(spark: SparkSession, frames: dict[str, DataFrame], limit: int = 20) -> list[str]:
    """Temporary views of the frames (``scorecard`` must be among them) and the report functions; returns the names of the functions."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    made = functions(limit)
    for name, (parameters, columns, query) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {query}")
    return list(made)


def call(spark: SparkSession, name: str, **values) -> DataFrame:
    """A report function with its arguments bound by name."""
    if name not in functions():
        raise ValueError(f"no report is named {name}")
    return spark.sql(f"SELECT * FROM {name}({', '.join(f'{v} => :{v}' for v in values)})", args=values)
